"""The role tables and the feature table as SQL common table expressions."""

ORDERS_PLAIN = """
orders_plain AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS order_purchase_timestamp,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) + to_hours((o_orderkey % 72)::INTEGER) AS order_approved_at,
    o_orderdate + INTERVAL 60 DAY AS order_estimated_delivery_date
  FROM orders)"""

ORDERS = ORDERS_PLAIN + """,
orders_r AS (
  SELECT p.*, s.order_delivered_carrier_date, s.order_delivered_customer_date
  FROM orders_plain p LEFT JOIN (
    SELECT l_orderkey AS order_id, min(l_shipdate) AS order_delivered_carrier_date,
           max(l_shipdate) AS order_delivered_customer_date
    FROM lineitem GROUP BY 1) s USING (order_id))"""

ITEMS = """
items_r AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
    l_suppkey AS seller_id, l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
  FROM lineitem)"""

PAYMENTS = """
payments_r AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
    l_linenumber AS payment_installments, l_extendedprice * (1 - l_discount) AS payment_value
  FROM lineitem)"""

REVIEWS = """
reviews_r AS (
  SELECT 'p' || o_orderkey AS review_id, o_orderkey AS order_id,
    substr(o_orderpriority, 1, 1)::INTEGER AS review_score,
    o_orderdate + INTERVAL 70 DAY AS review_answer_timestamp,
    source AS review_comment_title, text AS review_comment_message
  FROM orders LEFT JOIN documents ON doc_id = o_orderkey
  UNION ALL
  SELECT 'e' || event_id, user_id,
    CASE event_type WHEN 'purchase' THEN 5 WHEN 'signup' THEN 4 WHEN 'view' THEN 3 WHEN 'click' THEN 2 ELSE 1 END,
    ts, NULL, props
  FROM events)"""

LATEST = REVIEWS + """,
latest_r AS (
  SELECT order_id, review_score, review_comment_message, review_comment_title FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
      ORDER BY review_answer_timestamp DESC NULLS LAST, review_id DESC) AS rn FROM reviews_r)
  WHERE rn = 1)"""

CUSTOMERS = """
customers_r AS (
  SELECT c_custkey AS customer_id, c_nationkey::VARCHAR AS customer_zip_code_prefix,
    c_mktsegment AS customer_city, n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

SELLERS = """
sellers_r AS (
  SELECT s_suppkey AS seller_id, n_name AS seller_state, s_name AS seller_city
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""

PRODUCTS = """
translation_r AS (
  SELECT DISTINCT p_brand AS product_category_name,
    lower(replace(p_brand, '#', '_')) AS product_category_name_english
  FROM part WHERE p_brand <> 'Brand#25'),
products_r AS (
  SELECT p_partkey AS product_id, p_brand AS product_category_name,
    length(p_name)::DOUBLE AS product_name_lenght,
    (length(p_name) + length(p_type))::DOUBLE AS product_description_lenght,
    nullif(p_size % 16, 15)::DOUBLE AS product_photos_qty,
    nullif(p_size::DOUBLE * 100, 100) AS product_weight_g,
    p_size::DOUBLE AS product_length_cm, p_retailprice / 100 AS product_height_cm,
    (p_size + 1)::DOUBLE AS product_width_cm
  FROM part),
products_t AS (
  SELECT p.*, t.product_category_name_english
  FROM products_r p LEFT JOIN translation_r t USING (product_category_name))"""

REGIONS = """
regions_r AS (
  SELECT n_name AS state, lower(r_name) AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE lower(r_name) <> 'middle east')"""

ITEM_SUMMARY = ITEMS + """,
item_summary AS (
  SELECT order_id, count(order_item_id) AS order_item_count, coalesce(sum(price), 0) AS total_price,
    coalesce(sum(freight_value), 0) AS total_freight_value, avg(price) AS avg_price_per_item,
    max(price) AS max_price_item, min(price) AS min_price_item, count(DISTINCT seller_id) AS unique_sellers,
    coalesce(sum(freight_value), 0) / nullif(coalesce(sum(price), 0) + coalesce(sum(freight_value), 0), 0) AS freight_ratio
  FROM items_r GROUP BY order_id),
main_item AS (
  SELECT order_id, seller_id, product_id FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
      ORDER BY price DESC NULLS LAST, order_item_id, product_id, seller_id) AS rn FROM items_r)
  WHERE rn = 1)"""

PAYMENT_SUMMARY = PAYMENTS + """,
payment_summary AS (
  SELECT order_id, coalesce(sum(payment_value), 0) AS payment_value,
    max(payment_installments) AS payment_installments, count(DISTINCT payment_type) AS payment_types_count
  FROM payments_r GROUP BY order_id),
main_payment AS (
  SELECT order_id, payment_type FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
      ORDER BY payment_value DESC NULLS LAST, payment_sequential, payment_type) AS rn FROM payments_r)
  WHERE rn = 1)"""


def days(a: str, b: str) -> str:
    return f"(date_diff('microsecond', {a}, {b}) / 86400000000.0::DOUBLE)"


def hours(a: str, b: str) -> str:
    return f"(date_diff('microsecond', {a}, {b}) / 3600000000.0::DOUBLE)"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


_BUY, _ARR = "order_purchase_timestamp", "order_delivered_customer_date"
_EST, _APP = "order_estimated_delivery_date", "order_approved_at"

TIME_COLUMNS = f"""
  {days(_BUY, _ARR)} AS actual_delivery_days, {days(_EST, _ARR)} AS delivery_delay_days,
  {days(_BUY, _EST)} AS promised_delivery_days, {hours(_BUY, _APP)} AS approval_time_hours,
  {hours(_APP, 'order_delivered_carrier_date')} AS dispatch_time_hours,
  month({_BUY})::INTEGER AS purchase_month, (isodow({_BUY}) - 1)::INTEGER AS purchase_dayofweek,
  hour({_BUY})::INTEGER AS purchase_hour, strftime({_BUY}, '%Y-%m') AS purchase_year_month,
  CASE WHEN {days(_EST, _ARR)} <= 0 THEN 1 ELSE 0 END AS delivered_on_time,
  {days(_EST, _ARR)} / nullif({days(_BUY, _EST)}, 0) AS delay_ratio"""

TEXT_COLUMNS = f"""
  CASE WHEN length({strip('review_comment_message')}) > 0 THEN 1 ELSE 0 END AS has_comment,
  CASE WHEN length({strip('review_comment_title')}) > 0 THEN 1 ELSE 0 END AS has_review_title,
  length({strip("coalesce(review_comment_message, '')")})::BIGINT AS comment_length"""

BASE = ",".join([ORDERS, LATEST]) + f""",
base AS (
  SELECT o.*, r.* EXCLUDE (order_id) FROM orders_r o JOIN latest_r r USING (order_id)
  WHERE order_status = 'delivered')"""

MASTER = ",".join([BASE, ITEM_SUMMARY, PAYMENT_SUMMARY, CUSTOMERS, SELLERS, PRODUCTS, REGIONS]) + f""",
joined AS (
  SELECT b.*, {TIME_COLUMNS},
    i.* EXCLUDE (order_id), mi.seller_id, mi.product_id,
    p.* EXCLUDE (order_id), mp.payment_type,
    i.total_price + i.total_freight_value AS total_order_value,
    CASE WHEN unique_sellers > 1 THEN 1 ELSE 0 END AS is_multi_seller,
    CASE WHEN order_item_count > 1 THEN 1 ELSE 0 END AS is_multi_item,
    CASE WHEN payment_installments > 1 THEN 1 ELSE 0 END AS uses_installments,
    ln(1 + coalesce(p.payment_value, 0)) AS log_payment_value,
    ln(1 + coalesce(i.total_freight_value, 0)) AS log_freight_value,
    s.seller_state, s.seller_city,
    t.product_category_name_english, t.product_weight_g, t.product_length_cm, t.product_height_cm,
    t.product_width_cm, t.product_photos_qty, t.product_description_lenght, t.product_name_lenght,
    t.product_length_cm * t.product_height_cm * t.product_width_cm AS product_volume_cm3,
    CASE WHEN t.product_photos_qty > 0 THEN 1 ELSE 0 END AS has_product_photo,
    c.customer_state, c.customer_city, coalesce(g.region, 'outro') AS customer_region,
    CASE WHEN c.customer_state IN ('NATION_3', 'NATION_7') THEN 1 ELSE 0 END AS customer_high_risk_state,
    CASE WHEN s.seller_state = c.customer_state THEN 1 ELSE 0 END AS seller_customer_same_state,
    {TEXT_COLUMNS}
  FROM base b
  LEFT JOIN item_summary i USING (order_id) LEFT JOIN main_item mi USING (order_id)
  LEFT JOIN payment_summary p USING (order_id) LEFT JOIN main_payment mp USING (order_id)
  LEFT JOIN sellers_r s ON s.seller_id = mi.seller_id
  LEFT JOIN products_t t ON t.product_id = mi.product_id
  LEFT JOIN customers_r c ON c.customer_id = b.customer_id
  LEFT JOIN regions_r g ON g.state = c.customer_state),
master AS (
  SELECT *,
    coalesce(delivery_delay_days, 0) * coalesce(order_item_count, 1) AS interaccion_retraso_items,
    coalesce(payment_value, 0) * CASE WHEN delivery_delay_days > 0 THEN 1 ELSE 0 END AS interaccion_precio_tarde,
    coalesce(actual_delivery_days, 0) * coalesce(freight_ratio, 0) AS interaccion_entrega_flete,
    CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS satisfecho
  FROM joined WHERE review_score IS NOT NULL)"""

SCORED = """
scored AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderdate <= TIMESTAMP '1998-12-31' THEN 'Train'
         WHEN o_orderdate <= TIMESTAMP '1999-12-31' THEN 'Val' ELSE 'Backtest' END AS period,
    CASE WHEN substr(o_orderpriority, 1, 1)::INTEGER >= 4 THEN 1 ELSE 0 END AS label,
    ((round(o_totalprice * 100)::BIGINT % 1000) * 3 + substr(o_orderpriority, 1, 1)::INTEGER * 400)
      / 5000.0::DOUBLE AS proba
  FROM orders)"""


def sql(ctes: str | list[str], body: str) -> str:
    text = ctes if isinstance(ctes, str) else ",".join(ctes)
    return f"WITH {text.strip()}\n{body.strip()}"


EDA = ",".join([ORDERS, REVIEWS, ITEMS, PAYMENTS, CUSTOMERS, PRODUCTS]) + f""",
eda_items AS (
  SELECT order_id, count(order_item_id) AS order_item_count, coalesce(sum(freight_value), 0) AS total_freight_value,
    coalesce(sum(price), 0) AS total_price FROM items_r GROUP BY 1),
eda_first AS (
  SELECT order_id, seller_id, product_id FROM (SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY order_item_id, price, product_id, seller_id) AS rn FROM items_r) WHERE rn = 1),
eda_pay AS (
  SELECT order_id, max(payment_installments) AS payment_installments, coalesce(sum(payment_value), 0) AS payment_value
  FROM payments_r GROUP BY 1),
eda_ptype AS (
  SELECT order_id, payment_type FROM (SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY payment_sequential, payment_value, payment_type) AS rn FROM payments_r) WHERE rn = 1),
eda_rev AS (
  SELECT order_id, review_score, review_comment_message FROM (SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY review_id) AS rn FROM reviews_r) WHERE rn = 1),
eda_master AS (
  SELECT o.*, c.customer_state, c.customer_zip_code_prefix, p.* EXCLUDE (order_id), pt.payment_type,
    i.* EXCLUDE (order_id), f.seller_id, f.product_id,
    t.product_category_name_english, t.product_weight_g, t.product_photos_qty,
    r.review_score, r.review_comment_message
  FROM orders_r o LEFT JOIN customers_r c USING (customer_id)
  LEFT JOIN eda_pay p USING (order_id) LEFT JOIN eda_ptype pt USING (order_id)
  LEFT JOIN eda_items i USING (order_id) LEFT JOIN eda_first f USING (order_id)
  LEFT JOIN products_t t ON t.product_id = f.product_id LEFT JOIN eda_rev r USING (order_id)),
eda0 AS (
  SELECT *, floor({days(_BUY, _ARR)})::BIGINT AS dias_entrega, floor({days(_EST, _ARR)})::BIGINT AS dias_retraso,
    {hours(_BUY, _APP)} AS approval_time_hours,
    total_freight_value / (total_price + total_freight_value + 1e-9::DOUBLE) AS freight_ratio,
    total_price / (order_item_count + 1e-9::DOUBLE) AS precio_promedio_item,
    strftime({_BUY}, '%Y-%m') AS mes_compra, year({_BUY})::INTEGER AS anio_compra,
    CASE WHEN review_comment_message IS NOT NULL THEN 1 ELSE 0 END AS tiene_comentario,
    CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS satisfecho,
    CASE WHEN payment_installments > 1 THEN 1 ELSE 0 END AS pago_en_cuotas
  FROM eda_master),
eda AS (
  SELECT *, CASE WHEN dias_retraso > 0 THEN 1 ELSE 0 END AS es_tarde,
    CASE WHEN dias_retraso <= 0 THEN 1 ELSE 0 END AS delivered_on_time FROM eda0)"""
