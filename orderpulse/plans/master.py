"""The order-level master table, from role tables to winsorised features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators import features as ft
from orderpulse.sources.staging import stage


def order_features(
    tables: Mapping[str, DataFrame],
    regions: DataFrame | Mapping[str, Sequence[str]] = ft.STATE_REGIONS,
    high_risk: Sequence[str] = ft.HIGH_RISK_STATES,
    keep_score: bool = False,
) -> DataFrame:
    """Every feature domain joined to delivered, reviewed orders, before winsorising.

    Raw text columns stay in the frame; a plan that selects none of them never
    carries them.
    """
    base = ft.reviewed_orders_with_text(tables["orders"], tables["reviews"])
    base = ft.add_time_features(base)
    # items and payments of other orders are left out before they are sorted and summed up
    delivered = ft.delivered_orders(tables["orders"]).select("order_id")
    base = ft.add_value_features(
        base, ft.summarize_items(tables["items"], delivered), ft.summarize_payments(tables["payments"], delivered)
    )
    base = ft.add_complexity_features(base)
    base = ft.add_seller_features(base, tables["sellers"])
    base = ft.add_product_features(base, tables["products"], tables["translation"])
    base = ft.add_customer_features(base, tables["customers"], regions, high_risk)
    base = ft.add_interaction_features(base)
    return ft.add_target(base, keep_score=keep_score)


def master_table(
    tables: Mapping[str, DataFrame],
    regions: DataFrame | Mapping[str, Sequence[str]] = ft.STATE_REGIONS,
    high_risk: Sequence[str] = ft.HIGH_RISK_STATES,
    lower: float = 0.01,
    upper: float = 0.99,
    keep_text: bool = True,
) -> DataFrame:
    """The winsorised master table.

    The joined features are staged first: fitting the quantile bounds and
    clipping then read a columnar table instead of repeating the joins.  Without
    ``keep_text`` the review texts are read for their length only and never
    shuffled.
    """
    features = order_features(tables, regions, high_risk)
    if not keep_text:
        features = features.drop("review_comment_message", "review_comment_title")
    staged = stage(features, "features")
    return ft.winsorize(staged, lower=lower, upper=upper)


def exploratory_master(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The exploration join: every order, children reduced to one row each.

    "First" values follow the item and payment numbering, the first review is
    the one with the smallest id.
    """
    payments = tables["payments"]
    paid = payments.groupBy("order_id").agg(
        F.max("payment_installments").alias("payment_installments"),
        F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("payment_value"),
        F.min(F.when(F.col("payment_type").isNotNull(), F.struct("payment_sequential", "payment_value", "payment_type")))
        .getField("payment_type")
        .alias("payment_type"),
    )
    items = tables["items"]
    first = F.min(F.struct("order_item_id", "price", "product_id", "seller_id"))
    bought = (
        items.groupBy("order_id")
        .agg(
            F.count("order_item_id").alias("order_item_count"),
            F.coalesce(F.sum("freight_value"), F.lit(0.0)).alias("total_freight_value"),
            F.coalesce(F.sum("price"), F.lit(0.0)).alias("total_price"),
            first.alias("_first"),
        )
        .select("*", "_first.seller_id", "_first.product_id")
        .drop("_first")
    )
    described = ft.translate_categories(tables["products"], tables["translation"]).select(
        "product_id", "product_category_name_english", "product_weight_g", "product_photos_qty"
    )
    # the flag is taken before rows are shuffled: without the message's column no text leaves its scan
    flagged = tables["reviews"].select(
        "order_id", "review_id", "review_score", "review_comment_message",
        ex.flag(F.col("review_comment_message").isNotNull()).alias("tiene_comentario"),
    )
    reviews = ft.latest_per_key(flagged, ["order_id"], [F.col("review_id").asc()]).drop("review_id")
    return (
        tables["orders"]
        .join(
            tables["customers"].select("customer_id", "customer_state", "customer_zip_code_prefix"),
            "customer_id",
            "left",
        )
        .join(paid, "order_id", "left")
        .join(bought, "order_id", "left")
        .join(described, "product_id", "left")
        .join(reviews, "order_id", "left")
    )


