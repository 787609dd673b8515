"""The order-analytics roles, derived from a TPC-H-like star of tables.

Each function returns one role table with the column names the operators use.
Nothing is filtered or sampled; missing values come from unmatched joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

CUTOFFS = ("1998-12-31", "1999-12-31", "2000-12-31")
HIGH_RISK = ("NATION_3", "NATION_7")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def catalog(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: table(spark, folder, name) for name in TABLES}


def _plus(ts: Column, amount: Column, unit: str) -> Column:
    return F.timestamp_add(unit, amount.cast("int"), ts)


def priority_score(priority: Column) -> Column:
    """The digit that opens an order priority, read as a 1..5 score."""
    return F.substring(priority, 1, 1).cast("int")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: status, purchase time and delivery milestones."""
    o = table(spark, folder, "orders")
    shipped = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(
            F.min("l_shipdate").alias("order_delivered_carrier_date"),
            F.max("l_shipdate").alias("order_delivered_customer_date"),
        )
    )
    return orders_plain(o).join(shipped, "order_id", "left")


def orders_plain(o: DataFrame) -> DataFrame:
    """The order columns that need no line items."""
    purchase = _plus(F.col("o_orderdate"), F.pmod(F.col("o_orderkey") * 7919, F.lit(86400)), "SECOND")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
        .alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        _plus(purchase, F.pmod(F.col("o_orderkey"), F.lit(72)), "HOUR").alias("order_approved_at"),
        _plus(F.col("o_orderdate"), F.lit(60), "DAY").alias("order_estimated_delivery_date"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payment_value"),
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """A review per order, with the text of the like-numbered document, plus
    one per event of the like-numbered user, so that some orders have many."""
    base = table(spark, folder, "orders").select(
        F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        priority_score(F.col("o_orderpriority")).alias("review_score"),
        _plus(F.col("o_orderdate"), F.lit(70), "DAY").alias("review_answer_timestamp"),
    )
    texts = table(spark, folder, "documents").select(
        F.col("doc_id").alias("order_id"),
        F.col("source").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
    )
    score = (
        F.when(F.col("event_type") == "purchase", 5)
        .when(F.col("event_type") == "signup", 4)
        .when(F.col("event_type") == "view", 3)
        .when(F.col("event_type") == "click", 2)
        .otherwise(1)
    )
    later = table(spark, folder, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("review_id"),
        F.col("user_id").alias("order_id"),
        score.alias("review_score"),
        F.col("ts").alias("review_answer_timestamp"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
    )
    return base.join(texts, "order_id", "left").unionByName(later)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_state")
    )
    return table(spark, folder, "customer").join(nation, "c_nationkey", "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        "customer_state",
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seller_state")
    )
    return table(spark, folder, "supplier").join(nation, "s_nationkey", "left").select(
        F.col("s_suppkey").alias("seller_id"), "seller_state", F.col("s_name").alias("seller_city")
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size").cast("double")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        (F.length("p_name") + F.length("p_type")).cast("double").alias("product_description_lenght"),
        F.nullif(F.pmod(F.col("p_size"), F.lit(16)), F.lit(15)).cast("double").alias("product_photos_qty"),
        F.nullif(size * 100, F.lit(100.0)).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (F.col("p_retailprice") / 100).alias("product_height_cm"),
        (size + 1).alias("product_width_cm"),
    )


def translation(spark: SparkSession, folder: str) -> DataFrame:
    """Category names in another spelling; the last brand has no entry."""
    brand = F.col("p_brand")
    return (
        table(spark, folder, "part")
        .select(brand.alias("product_category_name"))
        .distinct()
        .where("product_category_name <> 'Brand#25'")
        .withColumn(
            "product_category_name_english",
            F.lower(F.replace(F.col("product_category_name"), F.lit("#"), F.lit("_"))),
        )
    )


def state_regions(spark: SparkSession, folder: str) -> DataFrame:
    """State to region; states of one region are left unmapped."""
    region = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.lower("r_name").alias("region")
    )
    return (
        table(spark, folder, "nation").join(region, "n_regionkey")
        .where("region <> 'middle east'")
        .select(F.col("n_name").alias("state"), "region")
    )


def roles(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "orders": orders(spark, folder),
        "reviews": reviews(spark, folder),
        "items": items(spark, folder),
        "payments": payments(spark, folder),
        "customers": customers(spark, folder),
        "products": products(spark, folder),
        "sellers": sellers(spark, folder),
        "translation": translation(spark, folder),
        "regions": state_regions(spark, folder),
    }


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """id, period, label and a probability with many ties, one row per order.

    The score mixes the cents of the order total with the priority digit, so it
    ranks the label well but not perfectly; all steps are exact in doubles.
    """
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    digit = priority_score(F.col("o_orderpriority"))
    date = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(date <= F.lit(CUTOFFS[0]).cast("timestamp_ntz"), "Train")
        .when(date <= F.lit(CUTOFFS[1]).cast("timestamp_ntz"), "Val")
        .otherwise("Backtest")
        .alias("period"),
        F.when(digit >= 4, 1).otherwise(0).alias("label"),
        ((F.pmod(cents, F.lit(1000)) * 3 + digit * 400) / F.lit(5000.0)).alias("proba"),
    )
