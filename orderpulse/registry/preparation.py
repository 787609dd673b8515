"""Split, encoding, scaling, fold and weight queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators import preparation as pr
from orderpulse.registry import Registry, r, roles_sql as R, rounded
from orderpulse.sources import star

Q = Registry()

LABELLED_SQL = R.ORDERS_PLAIN + f""",
labelled AS (
  SELECT p.*, o_totalprice AS price, o_orderpriority AS priority, c_mktsegment AS segment, c_acctbal AS balance,
    CASE WHEN substr(o_orderpriority, 1, 1)::INTEGER >= 4 THEN 1 ELSE 0 END AS satisfecho,
    CASE WHEN order_purchase_timestamp <= TIMESTAMP '{star.CUTOFFS[0]}' THEN 'train'
         WHEN order_purchase_timestamp <= TIMESTAMP '{star.CUTOFFS[1]}' THEN 'val'
         WHEN order_purchase_timestamp <= TIMESTAMP '{star.CUTOFFS[2]}' THEN 'backtest' ELSE 'live' END AS split,
    CASE WHEN year(o_orderdate) >= 2001 THEN c_mktsegment || ' ' || n_name ELSE c_mktsegment END AS category
  FROM orders_plain p JOIN orders ON o_orderkey = order_id
  LEFT JOIN customer ON c_custkey = customer_id LEFT JOIN nation ON n_nationkey = c_nationkey)"""


def labelled(spark, folder):
    """Orders with a label, a split and a category that gains unseen values late."""
    raw = star.table(spark, folder, "orders")
    customer = star.table(spark, folder, "customer").join(
        star.table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    segment = F.col("c_mktsegment")
    joined = star.orders_plain(raw).join(
        raw.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"),
            F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("_year"),
        ),
        "order_id",
    ).join(customer, F.col("customer_id") == F.col("c_custkey"), "left")
    out = joined.select(
        *star.orders_plain(raw).columns, "price", "priority", segment.alias("segment"),
        F.col("c_acctbal").alias("balance"),
        ex.binary_label(star.priority_score(F.col("priority"))).alias("satisfecho"),
        F.when(F.col("_year") >= 2001, F.concat_ws(" ", segment, "n_name")).otherwise(segment).alias("category"),
    )
    return pr.temporal_split(out, cutoffs=star.CUTOFFS)


@Q.query("temporal_split", R.sql(LABELLED_SQL, "SELECT order_id, split FROM labelled"))
def temporal_split(spark, folder):
    orders = star.orders_plain(star.table(spark, folder, "orders"))
    return pr.temporal_split(orders, cutoffs=star.CUTOFFS).select("order_id", "split")


@Q.query("split_summary", R.sql(LABELLED_SQL, f"""SELECT split, count(*) AS n_rows,
    strftime(min(order_purchase_timestamp), '%Y-%m') AS first_month,
    strftime(max(order_purchase_timestamp), '%Y-%m') AS last_month, {r('avg(satisfecho)', 'target_rate')}
    FROM labelled GROUP BY 1"""))
def split_summary(spark, folder):
    return rounded(pr.split_summary(labelled(spark, folder)))


@Q.query("target_encode", R.sql(LABELLED_SQL + """,
    te AS (SELECT category, avg(satisfecho) AS m FROM labelled WHERE split = 'train' GROUP BY 1)""",
    f"""SELECT order_id, split, {r("coalesce(m, (SELECT avg(satisfecho) FROM labelled WHERE split = 'train'))",
    'te_category', 6)} FROM labelled LEFT JOIN te USING (category)"""))
def target_encode(spark, folder):
    out = pr.target_encode(labelled(spark, folder), ["category"])
    return rounded(out.select("order_id", "split", "te_category"), 6)


_SCALED = ("price", "balance", "customer_id")


@Q.query("standardize", R.sql(LABELLED_SQL, f"""SELECT order_id, split, {', '.join(r(
    f"({c} - (SELECT avg({c}) FROM labelled WHERE split = 'train')) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM labelled WHERE split = 'train')",
    c, 6) for c in _SCALED)} FROM labelled"""))
def standardize(spark, folder):
    out = pr.standardize(labelled(spark, folder), list(_SCALED))
    return rounded(out.select("order_id", "split", *_SCALED), 6)


@Q.query("stratified_folds", R.sql(LABELLED_SQL, """SELECT order_id, satisfecho,
    ((row_number() OVER (PARTITION BY satisfecho ORDER BY md5(order_id::VARCHAR || ':2357'), order_id) - 1) % 5)::INTEGER AS fold
    FROM labelled"""))
def stratified_folds(spark, folder):
    return pr.stratified_folds(labelled(spark, folder)).select("order_id", "satisfecho", "fold")


@Q.query("class_weights", R.sql(LABELLED_SQL, f"""SELECT satisfecho, count(*) AS n,
    {r('sum(count(*)) OVER () / (2 * count(*))', 'weight', 6)},
    {r('count(*) / nullif(sum(count(*)) OVER () - count(*), 0)', 'ratio_to_other', 6)} FROM labelled GROUP BY 1"""))
def class_weights(spark, folder):
    return rounded(pr.class_weights(labelled(spark, folder)), 6)


@Q.query("split_readback", R.sql(LABELLED_SQL, """SELECT split, count(*) AS rows_expected, count(*) AS rows_written,
    0::BIGINT AS null_cells, true AS ok FROM labelled GROUP BY 1"""))
def split_readback(spark, folder):
    """Write the splits, read them back and compare rows and missing cells."""
    import uuid

    from orderpulse.sources import sinks
    from orderpulse.sources.staging import shared_folder

    df = labelled(spark, folder).select("order_id", "price", "satisfecho", "split")
    path = f"{shared_folder(spark)}/splits-{uuid.uuid4().hex}"
    sinks.write_splits(df, path)
    return sinks.verify_written(spark.read.parquet(path), df)


