"""Order feature queries, domain by domain, and the full master table."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators import features as ft
from orderpulse.plans import master
from orderpulse.registry import Registry, frames, r, roles_sql as R, rounded
from orderpulse.sources import star

Q = Registry()

TIME = (
    "actual_delivery_days", "delivery_delay_days", "promised_delivery_days", "approval_time_hours",
    "dispatch_time_hours", "delay_ratio",
)
TIME_PARTS = ("delivered_on_time", "purchase_month", "purchase_dayofweek", "purchase_hour", "purchase_year_month")
VALUE = (
    "total_price", "total_freight_value", "avg_price_per_item", "max_price_item", "min_price_item", "freight_ratio",
    "payment_value", "total_order_value",
)
VALUE_PARTS = ("order_item_count", "unique_sellers", "payment_installments", "payment_types_count", "payment_type")
INTERACTION = ("interaccion_retraso_items", "interaccion_precio_tarde", "interaccion_entrega_flete")
# Day fractions end within seven decimals, so seven compare without ties.
DIGITS = 7


def _cols(doubles, plain=()) -> str:
    return ", ".join(["order_id", *[r(c, c, DIGITS) for c in doubles], *plain])


@Q.query("date_features", R.sql(R.ORDERS_PLAIN, """SELECT order_id, month(order_purchase_timestamp)::INTEGER AS m,
    (isodow(order_purchase_timestamp) - 1)::INTEGER AS dow, hour(order_purchase_timestamp)::INTEGER AS h,
    year(order_purchase_timestamp)::INTEGER AS y, strftime(order_purchase_timestamp, '%Y-%m') AS ym,
    strftime(date_trunc('month', order_purchase_timestamp), '%Y-%m-%d') AS month_start FROM orders_plain"""))
def date_features(spark, folder):
    ts = F.col("order_purchase_timestamp")
    return star.orders_plain(star.table(spark, folder, "orders")).select(
        "order_id", F.month(ts).alias("m"), F.weekday(ts).alias("dow"), F.hour(ts).alias("h"), F.year(ts).alias("y"),
        ex.year_month(ts).alias("ym"), F.date_format(F.date_trunc("month", ts), "yyyy-MM-dd").alias("month_start"),
    )


@Q.query("floor_day_delta", R.sql(R.ORDERS, f"""SELECT order_id,
    floor({R.days('order_purchase_timestamp', 'order_delivered_customer_date')})::BIGINT AS dias_entrega,
    floor({R.days('order_estimated_delivery_date', 'order_delivered_customer_date')})::BIGINT AS dias_retraso,
    {r(R.days('order_estimated_delivery_date', 'order_delivered_customer_date'), 'exact_days')} FROM orders_r"""))
def floor_day_delta(spark, folder):
    o = star.orders(spark, folder)
    arrived = F.col("order_delivered_customer_date")
    return rounded(
        o.select(
            "order_id",
            ex.whole_days_between(F.col("order_purchase_timestamp"), arrived).alias("dias_entrega"),
            ex.whole_days_between(F.col("order_estimated_delivery_date"), arrived).alias("dias_retraso"),
            ex.days_between(F.col("order_estimated_delivery_date"), arrived).alias("exact_days"),
        )
    )


@Q.query("math_features", f"""SELECT l_orderkey, l_partkey, {r('ln(1 + l_extendedprice)', 'log_price')},
    {r('sqrt(l_extendedprice)', 'root_price')}, {r('exp(-l_discount)', 'decay')}, {r('ln(l_extendedprice)', 'ln_price')},
    {r('abs(l_discount - l_tax)', 'gap')}, {r('l_discount / nullif(l_tax, 0)', 'ratio')},
    {r('l_discount / (l_tax + 1e-9::DOUBLE)', 'guarded', 0)},
    {r('least(greatest(l_quantity, 5), 45)', 'clipped')} FROM lineitem""")
def math_features(spark, folder):
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    out = star.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", F.log1p(price).alias("log_price"), F.sqrt(price).alias("root_price"),
        F.exp(-disc).alias("decay"), F.ln(price).alias("ln_price"), F.abs(disc - tax).alias("gap"),
        ex.ratio(disc, tax).alias("ratio"), ex.guarded_ratio(disc, tax).alias("guarded"),
        ex.clip(F.col("l_quantity"), 5.0, 45.0).alias("clipped"),
    )
    return rounded(out.withColumn("guarded", F.round("guarded", 0)))


@Q.query("text_features", R.sql(f"""t AS (SELECT o_orderkey AS order_id, text AS review_comment_message,
    source AS review_comment_title FROM orders LEFT JOIN documents ON doc_id = o_orderkey)""",
    f"SELECT order_id, {R.TEXT_COLUMNS} FROM t"))
def text_features(spark, folder):
    texts = star.table(spark, folder, "documents").select(
        F.col("doc_id").alias("order_id"), F.col("text").alias("review_comment_message"),
        F.col("source").alias("review_comment_title"),
    )
    base = star.table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id")).join(
        texts, "order_id", "left"
    )
    return ft.add_text_features(base).drop("review_comment_message", "review_comment_title")


@Q.query("region_flags", R.sql(",".join([R.CUSTOMERS, R.REGIONS]), """SELECT customer_id, customer_state,
    coalesce(region, 'outro') AS customer_region,
    CASE WHEN customer_state IN ('NATION_3', 'NATION_7') THEN 1 ELSE 0 END AS customer_high_risk_state
    FROM customers_r LEFT JOIN regions_r ON state = customer_state"""))
def region_flags(spark, folder):
    base = star.table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
    return ft.add_customer_features(
        base, star.customers(spark, folder), star.state_regions(spark, folder), star.HIGH_RISK
    ).drop("customer_city")


@Q.query("features_time", R.sql(R.ORDERS + f", t AS (SELECT *, {R.TIME_COLUMNS} FROM orders_r)",
    f"SELECT {_cols(TIME, TIME_PARTS)} FROM t"))
def features_time(spark, folder):
    return rounded(ft.add_time_features(star.orders(spark, folder)).select("order_id", *TIME, *TIME_PARTS), DIGITS)


@Q.query("features_value", R.sql(R.MASTER, f"SELECT {_cols(VALUE, VALUE_PARTS)} FROM joined"))
def features_value(spark, folder):
    return rounded(
        ft.add_value_features(
            ft.reviewed_orders(star.orders(spark, folder), star.reviews(spark, folder)),
            ft.summarize_items(star.items(spark, folder)),
            ft.summarize_payments(star.payments(spark, folder)),
        ).select("order_id", *VALUE, *VALUE_PARTS),
        DIGITS,
    )


_COMPLEX = ("is_multi_seller", "is_multi_item", "uses_installments")


@Q.query("features_complexity", R.sql(R.MASTER, f"SELECT {_cols(('log_payment_value', 'log_freight_value'), _COMPLEX)} FROM joined"))
def features_complexity(spark, folder):
    base = ft.add_value_features(
        ft.reviewed_orders(star.orders(spark, folder), star.reviews(spark, folder)),
        ft.summarize_items(star.items(spark, folder)),
        ft.summarize_payments(star.payments(spark, folder)),
    )
    return rounded(
        ft.add_complexity_features(base).select("order_id", "log_payment_value", "log_freight_value", *_COMPLEX), DIGITS
    )


def _with_items(spark, folder):
    return ft.reviewed_orders(star.orders(spark, folder), star.reviews(spark, folder)).join(
        ft.summarize_items(star.items(spark, folder)), "order_id", "left"
    )


@Q.query("features_seller", R.sql(R.MASTER, "SELECT order_id, seller_id, seller_state, seller_city FROM joined"))
def features_seller(spark, folder):
    return ft.add_seller_features(_with_items(spark, folder), star.sellers(spark, folder)).select(
        "order_id", "seller_id", "seller_state", "seller_city"
    )


_PRODUCT = (
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm", "product_photos_qty",
    "product_description_lenght", "product_name_lenght", "product_volume_cm3",
)
_PRODUCT_PARTS = ("product_id", "product_category_name_english", "has_product_photo")


@Q.query("features_product", R.sql(R.MASTER, f"SELECT {_cols(_PRODUCT, _PRODUCT_PARTS)} FROM joined"))
def features_product(spark, folder):
    return rounded(
        ft.add_product_features(
            _with_items(spark, folder), star.products(spark, folder), star.translation(spark, folder)
        ).select("order_id", *_PRODUCT, *_PRODUCT_PARTS),
        DIGITS,
    )


_CUSTOMER = (
    "customer_state", "customer_city", "customer_region", "customer_high_risk_state", "seller_customer_same_state",
)


@Q.query("features_customer", R.sql(R.MASTER, f"SELECT order_id, {', '.join(_CUSTOMER)} FROM joined"))
def features_customer(spark, folder):
    base = ft.add_seller_features(_with_items(spark, folder), star.sellers(spark, folder))
    return ft.add_customer_features(
        base, star.customers(spark, folder), star.state_regions(spark, folder), star.HIGH_RISK
    ).select("order_id", *_CUSTOMER)


@Q.query("features_interaction", R.sql(R.MASTER, f"SELECT {_cols(INTERACTION)} FROM master"))
def features_interaction(spark, folder):
    return rounded(frames.features(spark, folder).select("order_id", *INTERACTION), DIGITS)


_WINSOR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _winsor_sql(source: str, columns) -> str:
    lo = ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in columns)
    return f"bounds AS (SELECT {lo} FROM {source})"


def _clip(c: str, digits: int = 4) -> str:
    return r(f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, lo_{c}), hi_{c}) END", c, digits)


@Q.query("winsorize", R.sql(_winsor_sql("lineitem", _WINSOR),
    f"SELECT l_orderkey, l_partkey, {', '.join(_clip(c) for c in _WINSOR)} FROM lineitem, bounds"))
def winsorize(spark, folder):
    items = star.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", *_WINSOR)
    return rounded(ft.winsorize(items, _WINSOR))


_MASTER_DOUBLES = tuple(
    c for c in (*TIME, *VALUE, "log_payment_value", "log_freight_value", *_PRODUCT, *INTERACTION)
    if c not in ft.WINSOR_COLUMNS
)
_MASTER_PLAIN = (
    "customer_id", "order_status", *TIME_PARTS, *VALUE_PARTS, *_COMPLEX, "seller_id", "seller_state", "seller_city",
    *_PRODUCT_PARTS, *_CUSTOMER, "has_comment", "has_review_title", "satisfecho",
)


MASTER_DATES = (
    "order_purchase_timestamp", "order_approved_at", "order_estimated_delivery_date", "order_delivered_carrier_date",
    "order_delivered_customer_date",
)
MASTER_TEXTS = (
    "order_status", "customer_state", "customer_city", "customer_region", "seller_state", "seller_city", "payment_type",
    "product_category_name_english", "purchase_year_month", "review_comment_message", "review_comment_title",
)
MASTER_NUMBERS = (
    "order_id", *(c for c in (*_MASTER_DOUBLES, *_MASTER_PLAIN, *ft.WINSOR_COLUMNS) if c not in MASTER_TEXTS),
)
#: Every column of the feature master.
MASTER_COLUMNS = (*MASTER_DATES, *MASTER_TEXTS, *MASTER_NUMBERS)


@Q.query("master_features", R.sql(R.MASTER + ", " + _winsor_sql("master", ft.WINSOR_COLUMNS),
    f"""SELECT {_cols(_MASTER_DOUBLES, _MASTER_PLAIN)}, {', '.join(_clip(c, DIGITS) for c in ft.WINSOR_COLUMNS)}
    FROM master, bounds"""))
def master_features(spark, folder):
    tables = star.roles(spark, folder)
    out = master.master_table(tables, tables["regions"], star.HIGH_RISK, keep_text=False)
    return rounded(out.select("order_id", *_MASTER_DOUBLES, *_MASTER_PLAIN, *ft.WINSOR_COLUMNS), DIGITS)


_EDA_DOUBLES = ("approval_time_hours", "precio_promedio_item")
_EDA_PLAIN = (
    "dias_entrega", "dias_retraso", "es_tarde", "delivered_on_time", "mes_compra", "anio_compra", "tiene_comentario",
    "satisfecho", "pago_en_cuotas",
)


@Q.query("features_eda_variant", R.sql(R.EDA,
    f"SELECT {_cols(_EDA_DOUBLES, _EDA_PLAIN)}, {r('freight_ratio', 'freight_ratio', 6)} FROM eda"))
def features_eda_variant(spark, folder):
    e = frames.explored(spark, folder)
    return e.select(
        "order_id", *[(F.round(c, DIGITS) + F.lit(0.0)).alias(c) for c in _EDA_DOUBLES], *_EDA_PLAIN,
        (F.round("freight_ratio", 6) + F.lit(0.0)).alias("freight_ratio"),
    )
