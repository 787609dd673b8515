"""One-row-per-order features, grouped by domain.

Each ``add_*`` function takes and returns the order-level frame; summaries of
the child tables are built first, so joins never multiply orders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators.ordering import latest_per_key
from orderpulse.operators.quantiles import exact_quantiles

# Brazilian states by region, and states known for low scores.
STATE_REGIONS: dict[str, list[str]] = {
    "nordeste": ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"],
    "norte": ["AM", "RR", "AP", "PA", "TO", "RO", "AC"],
    "sudeste": ["SP", "RJ", "MG", "ES"],
    "sul": ["PR", "SC", "RS"],
    "centro_oeste": ["GO", "MT", "MS", "DF"],
}
OTHER_REGION = "outro"
HIGH_RISK_STATES = ("RR", "AL", "MA", "SE", "PA")

REVIEW_COLUMNS = ("review_score", "review_comment_message", "review_comment_title")
TEXT_FEATURES = ("has_comment", "has_review_title", "comment_length")

# Columns winsorised at the 1st and 99th percentile.
WINSOR_COLUMNS = (
    "actual_delivery_days", "delivery_delay_days", "approval_time_hours",
    "dispatch_time_hours", "total_price", "total_freight_value",
    "payment_value", "freight_ratio", "delay_ratio",
    "product_weight_g", "product_volume_cm3", "comment_length",
    "interaccion_retraso_items", "interaccion_precio_tarde", "interaccion_entrega_flete",
)


def delivered_orders(orders: DataFrame, status: str = "delivered") -> DataFrame:
    return orders.where(F.col("order_status") == status)


def latest_reviews(reviews: DataFrame, columns: Sequence[str] = REVIEW_COLUMNS) -> DataFrame:
    """The most recently answered review per order; undated ones come last."""
    return latest_per_key(
        reviews,
        ["order_id"],
        [F.col("review_answer_timestamp").desc_nulls_last(), F.col("review_id").desc()],
    ).select("order_id", *columns)


def reviewed_orders(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Delivered orders that have a review, one row per order."""
    return delivered_orders(orders).join(latest_reviews(reviews), "order_id", "inner")


def reviewed_orders_with_text(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """The same with text features, taken where the reviews are read.

    When nobody reads the raw text later, only its length and flags travel
    through the shuffles and joins.
    """
    described = latest_reviews(add_text_features(reviews), (*REVIEW_COLUMNS, *TEXT_FEATURES))
    return delivered_orders(orders).join(described, "order_id", "inner")


def main_items(items: DataFrame) -> DataFrame:
    """Seller and product of the most expensive item per order; item numbers break ties."""
    order = [F.col("price").desc_nulls_last(), F.col("order_item_id"), F.col("product_id"), F.col("seller_id")]
    return latest_per_key(
        items.select("order_id", "price", "order_item_id", "product_id", "seller_id"), ["order_id"], order
    ).select("order_id", "seller_id", "product_id")


def _largest_first(value: str) -> list[Column]:
    """Sort keys, all ascending: NaN, then numbers from the largest, then missing ones."""
    v = F.col(value)
    return [F.when(v.isNull(), 2).when(F.isnan(v), 0).otherwise(1), F.when(~F.isnan(v), -v)]


def _by_order(rows: DataFrame, orders: DataFrame | None) -> GroupedData:
    """Rows grouped by order, without those that have none; of listed orders only, where these are given."""
    known = rows.where(F.col("order_id").isNotNull())
    return (known if orders is None else known.join(orders.select("order_id"), "order_id", "left_semi")).groupBy("order_id")


def summarize_items(items: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Counts, prices and the main item per order, of ``orders`` only if given.

    One aggregation holds the sums, the order's sellers and its main item, so an
    order sends a row per task and is shuffled once.
    """
    price, freight = F.col("total_price"), F.col("total_freight_value")
    first = F.min(F.struct(*_largest_first("price"), F.col("order_item_id"), F.col("product_id"), F.col("seller_id")))
    sums = _by_order(items, orders).agg(
        F.count("order_item_id").alias("order_item_count"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("total_price"),
        F.coalesce(F.sum("freight_value"), F.lit(0.0)).alias("total_freight_value"),
        (F.sum("price") / F.count("price")).alias("avg_price_per_item"),
        F.max("price").alias("max_price_item"),
        F.min("price").alias("min_price_item"),
        F.size(F.collect_set("seller_id")).cast("long").alias("unique_sellers"),
        first.alias("_first"),
    )
    out = sums.withColumn("freight_ratio", ex.ratio(freight, price + freight))
    return out.select("*", "_first.seller_id", "_first.product_id").drop("_first")


def main_payments(payments: DataFrame) -> DataFrame:
    """Type of the largest payment per order; payment numbers break ties."""
    order = [F.col("payment_value").desc_nulls_last(), F.col("payment_sequential"), F.col("payment_type")]
    return latest_per_key(
        payments.select("order_id", "payment_value", "payment_sequential", "payment_type"), ["order_id"], order
    ).select("order_id", "payment_type")


def summarize_payments(payments: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Paid value, instalments and the dominant payment type per order, of ``orders`` only if given; shuffled once."""
    first = F.min(F.struct(*_largest_first("payment_value"), F.col("payment_sequential"), F.col("payment_type")))
    sums = _by_order(payments, orders).agg(
        F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("payment_value"),
        F.max("payment_installments").alias("payment_installments"),
        F.size(F.collect_set("payment_type")).cast("long").alias("payment_types_count"),
        first.alias("_first"),
    )
    return sums.select("*", "_first.payment_type").drop("_first")


def add_time_features(base: DataFrame) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    approved = F.col("order_approved_at")
    arrived = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")
    spans = base.withColumns(
        {
            "actual_delivery_days": ex.days_between(bought, arrived),
            "delivery_delay_days": ex.days_between(promised, arrived),
            "promised_delivery_days": ex.days_between(bought, promised),
            "approval_time_hours": ex.hours_between(bought, approved),
            "dispatch_time_hours": ex.hours_between(approved, F.col("order_delivered_carrier_date")),
            "purchase_month": F.month(bought),
            "purchase_dayofweek": F.weekday(bought),
            "purchase_hour": F.hour(bought),
            "purchase_year_month": ex.year_month(bought),
        }
    )
    return spans.withColumns(
        {
            "delivered_on_time": ex.flag(F.col("delivery_delay_days") <= 0),
            "delay_ratio": ex.ratio(F.col("delivery_delay_days"), F.col("promised_delivery_days")),
        }
    )


def add_value_features(base: DataFrame, item_summary: DataFrame, payment_summary: DataFrame) -> DataFrame:
    return (
        base.join(item_summary, "order_id", "left")
        .join(payment_summary, "order_id", "left")
        .withColumn("total_order_value", F.col("total_price") + F.col("total_freight_value"))
    )


def add_complexity_features(base: DataFrame) -> DataFrame:
    return base.withColumns(
        {
            "is_multi_seller": ex.flag(F.col("unique_sellers") > 1),
            "is_multi_item": ex.flag(F.col("order_item_count") > 1),
            "uses_installments": ex.flag(F.col("payment_installments") > 1),
            "log_payment_value": F.log1p(F.coalesce(F.col("payment_value"), F.lit(0.0))),
            "log_freight_value": F.log1p(F.coalesce(F.col("total_freight_value"), F.lit(0.0))),
        }
    )


def add_seller_features(base: DataFrame, sellers: DataFrame) -> DataFrame:
    return base.join(sellers.select("seller_id", "seller_state", "seller_city"), "seller_id", "left")


def translate_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    return products.join(
        translation.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        "left",
    )


def add_product_features(base: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    described = translate_categories(products, translation).select(
        "product_id", "product_category_name_english", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
        "product_photos_qty", "product_description_lenght", "product_name_lenght",
    )
    return base.join(described, "product_id", "left").withColumns(
        {
            "product_volume_cm3": F.col("product_length_cm")
            * F.col("product_height_cm")
            * F.col("product_width_cm"),
            "has_product_photo": ex.flag(F.col("product_photos_qty") > 0),
        }
    )


def add_customer_features(
    base: DataFrame,
    customers: DataFrame,
    regions: DataFrame | Mapping[str, Sequence[str]] = STATE_REGIONS,
    high_risk: Sequence[str] = HIGH_RISK_STATES,
    other: str = OTHER_REGION,
) -> DataFrame:
    """State, city, region, risk flag and same-state flag.

    ``regions`` is a region -> states mapping or a (state, region) table.
    """
    out = base.join(customers.select("customer_id", "customer_state", "customer_city"), "customer_id", "left")
    if isinstance(regions, DataFrame):
        known = regions.select(F.col("state").alias("customer_state"), F.col("region").alias("customer_region"))
        out = out.join(known, "customer_state", "left").withColumn(
            "customer_region", F.coalesce("customer_region", F.lit(other))
        )
    else:
        by_state = {state: region for region, states in regions.items() for state in states}
        out = out.withColumn("customer_region", ex.map_values(F.col("customer_state"), by_state, other))
    flags = {"customer_high_risk_state": ex.member_flag(F.col("customer_state"), high_risk)}
    if "seller_state" in base.columns:
        flags["seller_customer_same_state"] = ex.flag(F.col("seller_state") == F.col("customer_state"))
    return out.withColumns(flags)


def add_text_features(base: DataFrame) -> DataFrame:
    message, title = F.col("review_comment_message"), F.col("review_comment_title")
    return base.withColumns(
        {
            "has_comment": ex.has_text(message),
            "has_review_title": ex.has_text(title),
            "comment_length": ex.text_length(message),
        }
    )


def add_interaction_features(base: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    delay = F.coalesce("delivery_delay_days", zero)
    return base.withColumns(
        {
            "interaccion_retraso_items": delay * F.coalesce("order_item_count", F.lit(1)),
            "interaccion_precio_tarde": F.coalesce("payment_value", zero) * ex.flag(delay > 0),
            "interaccion_entrega_flete": F.coalesce("actual_delivery_days", zero)
            * F.coalesce("freight_ratio", zero),
        }
    )


def add_target(base: DataFrame, threshold: float = 4, keep_score: bool = False) -> DataFrame:
    """Label orders by score; rows whose score is not a number are dropped."""
    scored = (
        base.withColumn("review_score", F.col("review_score").try_cast("double"))
        .where(F.col("review_score").isNotNull() & ~F.isnan("review_score"))
        .withColumn("satisfecho", ex.binary_label(F.col("review_score"), threshold))
    )
    return scored if keep_score else scored.drop("review_score")


def winsor_bounds(
    df: DataFrame, columns: Sequence[str], lower: float = 0.01, upper: float = 0.99
) -> dict[str, tuple[float, float]]:
    """Exact quantile bounds of the columns the frame has; empty columns are left out."""
    present = [c for c in columns if c in df.columns]
    found = exact_quantiles(df, present, [lower, upper])
    return {c: (q[0], q[1]) for c, q in found.items() if q[0] is not None}


def clip_to(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns(
        {c: ex.clip(F.col(c).cast("double"), low, high) for c, (low, high) in bounds.items()}
    )


def winsorize(
    df: DataFrame,
    columns: Sequence[str] = WINSOR_COLUMNS,
    lower: float = 0.01,
    upper: float = 0.99,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Clamp columns to quantile bounds, fitted on all rows unless told otherwise."""
    return clip_to(df, winsor_bounds(fit_on if fit_on is not None else df, columns, lower, upper))


def add_exploratory_features(base: DataFrame) -> DataFrame:
    """The notebook variant: whole-day spans and guarded ratios (0 when both are 0).

    A comment flag the frame already has is kept, so raw text need not be read.
    """
    bought = F.col("order_purchase_timestamp")
    arrived = F.col("order_delivered_customer_date")
    out = base.withColumns(
        {
            "dias_entrega": ex.whole_days_between(bought, arrived),
            "dias_retraso": ex.whole_days_between(F.col("order_estimated_delivery_date"), arrived),
            "approval_time_hours": ex.hours_between(bought, F.col("order_approved_at")),
            "freight_ratio": ex.guarded_ratio(
                F.col("total_freight_value"), F.col("total_price") + F.col("total_freight_value")
            ),
            "precio_promedio_item": ex.guarded_ratio(F.col("total_price"), F.col("order_item_count")),
            "mes_compra": ex.year_month(bought),
            "anio_compra": F.year(bought),
            "tiene_comentario": F.coalesce("tiene_comentario", F.lit(0))
            if "tiene_comentario" in base.columns
            else ex.flag(F.col("review_comment_message").isNotNull()),
            "satisfecho": ex.binary_label(F.col("review_score")),
            "pago_en_cuotas": ex.flag(F.col("payment_installments") > 1),
        }
    )
    return out.withColumns(
        {
            "es_tarde": ex.flag(F.col("dias_retraso") > 0),
            "delivered_on_time": ex.flag(F.col("dias_retraso") <= 0),
        }
    )
