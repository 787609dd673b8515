"""Catalog, projection, join and grouping queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators import aggregates as ag, features as ft, ordering as od, quality as qa
from orderpulse.plans import master
from orderpulse.registry import Registry, frames, r, roles_sql as R, rounded
from orderpulse.sources import catalog, star

Q = Registry()


@Q.query(
    "scan_catalog_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in star.TABLES),
)
def scan_catalog_counts(spark, folder):
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        for name, df in star.catalog(spark, folder).items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@Q.query(
    "filter_delivered",
    R.sql(R.ORDERS, "SELECT order_id, customer_id FROM orders_r WHERE order_status = 'delivered'"),
)
def filter_delivered(spark, folder):
    return ft.delivered_orders(star.orders(spark, folder)).select("order_id", "customer_id")


@Q.query(
    "filter_between",
    R.sql(R.EDA, "SELECT order_id, dias_retraso FROM eda WHERE dias_retraso BETWEEN -30 AND 60"),
)
def filter_between(spark, folder):
    return frames.explored(spark, folder).where(F.col("dias_retraso").between(-30, 60)).select(
        "order_id", "dias_retraso"
    )


_DROP = {
    "ids": ["customer_id", "seller_id", "no_such_id"],
    "fechas": ["order_approved_at", "order_estimated_delivery_date"],
}


@Q.query(
    "drop_columns_report",
    """SELECT * FROM (VALUES ('ids', 'customer_id', 1), ('ids', 'seller_id', 0), ('ids', 'no_such_id', 0),
       ('fechas', 'order_approved_at', 1), ('fechas', 'order_estimated_delivery_date', 1)) AS
       t(column_group, column_name, dropped), (SELECT count(*) AS n_rows, 6 AS columns_left FROM orders)""".replace(
        "6 AS columns_left", "5::INTEGER AS columns_left"
    ),
)
def drop_columns_report(spark, folder):
    orders = star.orders(spark, folder)
    kept, log = qa.drop_listed(orders, _DROP)
    n = kept.agg(F.count("*").alias("n"))
    return log.withColumn("n_rows", n.scalar()).withColumn("columns_left", F.lit(len(kept.columns)))


@Q.query(
    "coerce_types",
    """SELECT event_id, try_cast(substr(props, 1, 5) AS DOUBLE) AS bad_number,
       coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE), 0)::INTEGER AS k,
       user_id::VARCHAR AS user_text,
       strftime(try_cast(ts::VARCHAR AS TIMESTAMP), '%Y-%m-%d %H:%M') AS ts_minute,
       try_cast(event_type AS TIMESTAMP) IS NULL AS bad_date FROM events""",
)
def coerce_types(spark, folder):
    raw = star.table(spark, folder, "events").select(
        "event_id",
        F.substring("props", 1, 5).alias("bad_number"),
        F.get_json_object("props", "$.k").alias("k"),
        F.col("user_id").alias("user_text"),
        F.col("ts").cast("string").alias("ts_text"),
        F.col("event_type").alias("bad"),
    )
    out = catalog.coerce_types(
        raw, dates=["ts_text", "bad"], numbers=["bad_number"], whole=["k"], text=["user_text"]
    )
    return out.select(
        "event_id", "bad_number", "k", "user_text",
        F.date_format("ts_text", "yyyy-MM-dd HH:mm").alias("ts_minute"),
        F.col("bad").isNull().alias("bad_date"),
    )


@Q.query(
    "make_target",
    R.sql(
        R.BASE,
        "SELECT order_id, CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS satisfecho, "
        "CASE WHEN review_score >= 4 THEN 'Satisfecho (4-5)' ELSE 'Insatisfecho (1-3)' END AS etiqueta FROM base",
    ),
)
def make_target(spark, folder):
    t = star.roles(spark, folder)
    labelled = ft.add_target(ft.reviewed_orders(t["orders"], t["reviews"]))
    text = F.when(F.col("satisfecho") == 1, "Satisfecho (4-5)").otherwise("Insatisfecho (1-3)")
    return labelled.select("order_id", "satisfecho", text.alias("etiqueta"))


@Q.query(
    "base_orders_latest_review",
    R.sql(R.BASE, "SELECT order_id, customer_id, review_score, review_comment_title, review_comment_message FROM base"),
)
def base_orders_latest_review(spark, folder):
    t = star.roles(spark, folder)
    return ft.reviewed_orders(t["orders"], t["reviews"]).select(
        "order_id", "customer_id", "review_score", "review_comment_title", "review_comment_message"
    )


@Q.query(
    "join_fanout",
    R.sql(
        ",".join([R.ORDERS_PLAIN, R.REVIEWS]),
        "SELECT order_id, review_id, order_status, review_score FROM orders_plain LEFT JOIN reviews_r USING (order_id)",
    ),
)
def join_fanout(spark, folder):
    orders = star.orders_plain(star.table(spark, folder, "orders"))
    return orders.join(star.reviews(spark, folder), "order_id", "left").select(
        "order_id", "review_id", "order_status", "review_score"
    )


@Q.query(
    "left_join_child_aggs",
    R.sql(
        ",".join([R.ORDERS_PLAIN, R.ITEM_SUMMARY, R.PAYMENT_SUMMARY]),
        f"""SELECT order_id, order_item_count, {r('total_price', 'total_price')},
        {r('payment_value', 'payment_value')}, payment_installments
        FROM orders_plain LEFT JOIN item_summary USING (order_id) LEFT JOIN payment_summary USING (order_id)""",
    ),
)
def left_join_child_aggs(spark, folder):
    orders = star.orders_plain(star.table(spark, folder, "orders"))
    joined = ft.add_value_features(
        orders, ft.summarize_items(star.items(spark, folder)), ft.summarize_payments(star.payments(spark, folder))
    )
    return rounded(
        joined.select("order_id", "order_item_count", "total_price", "payment_value", "payment_installments")
    )


@Q.query(
    "dimension_lookup",
    R.sql(
        ",".join([R.ITEMS, R.SELLERS, R.PRODUCTS]),
        f"""SELECT order_id, order_item_id, {r('price', 'price')}, seller_state, product_category_name_english
        FROM items_r LEFT JOIN sellers_r USING (seller_id) LEFT JOIN products_t USING (product_id)""",
    ),
)
def dimension_lookup(spark, folder):
    described = ft.translate_categories(star.products(spark, folder), star.translation(spark, folder))
    joined = (
        star.items(spark, folder)
        .join(star.sellers(spark, folder), "seller_id", "left")
        .join(described, "product_id", "left")
    )
    return rounded(
        joined.select("order_id", "order_item_id", "price", "seller_state", "product_category_name_english")
    )


@Q.query(
    "master_table_eda",
    R.sql(
        R.EDA,
        f"""SELECT order_id, order_status, customer_state, customer_zip_code_prefix, payment_installments,
        {r('payment_value', 'payment_value')}, payment_type, order_item_count,
        {r('total_freight_value', 'total_freight_value')}, {r('total_price', 'total_price')}, seller_id,
        product_category_name_english, {r('product_weight_g', 'product_weight_g')},
        {r('product_photos_qty', 'product_photos_qty')}, review_score, review_comment_message FROM eda_master""",
    ),
)
def master_table_eda(spark, folder):
    return rounded(
        master.exploratory_master(star.roles(spark, folder)).select(
            "order_id", "order_status", "customer_state", "customer_zip_code_prefix", "payment_installments",
            "payment_value", "payment_type", "order_item_count", "total_freight_value", "total_price", "seller_id",
            "product_category_name_english", "product_weight_g", "product_photos_qty", "review_score",
            "review_comment_message",
        )
    )


_ITEM_COLS = (
    "total_price", "total_freight_value", "avg_price_per_item", "max_price_item", "min_price_item",
)


@Q.query(
    "items_per_order",
    R.sql(
        R.ITEM_SUMMARY,
        f"""SELECT order_id, order_item_count, unique_sellers, {', '.join(r(c, c, 6) for c in _ITEM_COLS)},
        {r('freight_ratio', 'freight_ratio', 6)} FROM item_summary""",
    ),
)
def items_per_order(spark, folder):
    s = ft.summarize_items(star.items(spark, folder))
    six = s.withColumn("freight_ratio", F.round("freight_ratio", 6))
    other = {c: F.round(c, 6) + F.lit(0.0) for c in _ITEM_COLS}
    return six.withColumns(other).select("order_id", "order_item_count", "unique_sellers", *_ITEM_COLS, "freight_ratio")


@Q.query(
    "payments_per_order",
    R.sql(
        R.PAYMENT_SUMMARY,
        f"SELECT order_id, {r('payment_value', 'payment_value')}, payment_installments, payment_types_count FROM payment_summary",
    ),
)
def payments_per_order(spark, folder):
    return rounded(ft.summarize_payments(star.payments(spark, folder)).drop("payment_type"))


@Q.query(
    "first_per_group",
    R.sql(
        R.PAYMENTS,
        """SELECT order_id, arg_min(payment_type, (payment_sequential, payment_value)) AS payment_type
        FROM payments_r GROUP BY 1""",
    ),
)
def first_per_group(spark, folder):
    return ag.first_per_group(
        star.payments(spark, folder), ["order_id"], ["payment_type"], ["payment_sequential", "payment_value"]
    )


@Q.query(
    "latest_per_key",
    R.sql(
        R.REVIEWS,
        """SELECT order_id, review_id, review_score FROM (SELECT *, row_number() OVER (PARTITION BY order_id
        ORDER BY review_answer_timestamp DESC NULLS LAST, review_id DESC) AS rn FROM reviews_r) WHERE rn = 1""",
    ),
)
def latest_per_key(spark, folder):
    return od.latest_per_key(
        star.reviews(spark, folder).select("order_id", "review_id", "review_score", "review_answer_timestamp"),
        ["order_id"],
        [F.col("review_answer_timestamp").desc_nulls_last(), F.col("review_id").desc()],
    ).drop("review_answer_timestamp")


@Q.query("dominant_payment", R.sql(R.PAYMENT_SUMMARY, "SELECT * FROM main_payment"))
def dominant_payment(spark, folder):
    return ft.main_payments(star.payments(spark, folder))


@Q.query("main_item", R.sql(R.ITEM_SUMMARY, "SELECT * FROM main_item"))
def main_item(spark, folder):
    return ft.main_items(star.items(spark, folder))


@Q.query(
    "running_max",
    R.sql(
        R.ORDERS_PLAIN,
        f"""SELECT order_status, month, {r('value', 'value')}, {r('best', 'best')} FROM (
        SELECT *, max(value) OVER (PARTITION BY order_status ORDER BY month) AS best FROM (
          SELECT order_status, strftime(order_purchase_timestamp, '%Y-%m') AS month, sum(o_totalprice) AS value
          FROM orders_plain JOIN orders ON o_orderkey = order_id GROUP BY 1, 2))""",
    ),
)
def running_max(spark, folder):
    raw = star.table(spark, folder, "orders")
    orders = star.orders_plain(raw).join(
        raw.select(F.col("o_orderkey").alias("order_id"), "o_totalprice"), "order_id"
    )
    monthly = orders.groupBy("order_status", ex.year_month(F.col("order_purchase_timestamp")).alias("month")).agg(
        F.sum("o_totalprice").alias("value")
    )
    return rounded(od.running_max(monthly, ["order_status"], [F.col("month")], "value", "best"))


@Q.query(
    "duplicate_rows",
    """SELECT (SELECT count(*) FROM lineitem) AS n_rows,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicates""",
)
def duplicate_rows(spark, folder):
    return qa.duplicate_count(star.table(spark, folder, "lineitem"))


@Q.query(
    "seeded_sample",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
       ORDER BY md5(o_orderkey::VARCHAR || ':2357'), o_orderkey LIMIT 500""",
)
def seeded_sample(spark, folder):
    orders = star.orders_plain(star.table(spark, folder, "orders")).select("order_id", "customer_id")
    return od.seeded_sample(orders, "order_id", 500, 2357)
