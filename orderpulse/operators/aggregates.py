"""Grouped summaries, KPIs, frequency tables, describe tables, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators.arrays import per_column
from orderpulse.operators.quantiles import exact_quantiles, quantiles_by_group


def first_per_group(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """First non-missing value of each column per group, under a stated order."""
    rank = F.struct(*order)
    return df.groupBy(*by).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns]
    )


def mean_by_key(df: DataFrame, key: str, value: str, out: str = "mean") -> DataFrame:
    """Group mean; rows with a missing key form no group."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(out))


def means_by_key(df: DataFrame, key: str, values: Sequence[str], digits: int = 2) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.round(F.avg(v), digits).alias(v) for v in values]
    )


def category_satisfaction(
    df: DataFrame, key: str, score: str = "review_score", min_orders: int = 0
) -> DataFrame:
    """Mean score and order count per category with enough support."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(score).alias("avg_score"), F.count("order_id").alias("orders"))
        .where(F.col("orders") >= min_orders)
    )


def top_and_bottom(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """The n lowest and n highest rows, each side ranked from its extreme."""
    low = df.orderBy(F.col(measure).asc(), key).limit(n).withColumn("side", F.lit("bottom"))
    high = df.orderBy(F.col(measure).desc(), key).limit(n).withColumn("side", F.lit("top"))
    return low.unionByName(high)


def monthly_trend(
    df: DataFrame, ts: str = "order_purchase_timestamp", score: str = "review_score", min_orders: int = 50
) -> DataFrame:
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(ex.year_month(F.col(ts)).alias("month"))
        .agg(F.avg(score).alias("avg_score"), F.count("order_id").alias("orders"))
        .where(F.col("orders") >= min_orders)
    )


def best_and_worst(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Key of the highest and the lowest measure; the first key wins a tie."""
    return df.agg(
        F.min_by(key, F.struct(-F.col(measure), F.col(key))).alias("best"),
        F.min_by(key, F.struct(F.col(measure), F.col(key))).alias("worst"),
        F.avg(measure).alias("mean_measure"),
        F.count("*").alias("groups"),
    )


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """Count, share and percent of each value; missing values are not counted."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    # the total comes from the already grouped counts
    total = counts.agg(F.sum("n").cast("double").alias("t"))
    share = F.col("n") / total.scalar()
    return counts.select(column, "n", share.alias("share"), (share * 100).alias("percent"))


def kpi_totals(df: DataFrame) -> DataFrame:
    """Scalar KPIs of the order frame in one pass.

    Needs review_score, es_tarde, dias_retraso and payment_value.
    """
    score, paid = F.col("review_score"), F.col("payment_value")
    rated = F.count(score).cast("double")
    return df.agg(
        F.count("*").alias("orders"),
        (F.count_if(score >= 4) / F.nullif(rated, F.lit(0.0)) * 100).alias("customer_satisfaction_rate"),
        (F.count_if(score <= 3) / F.nullif(rated, F.lit(0.0)) * 100).alias("unsatisfied_rate"),
        F.avg(score).alias("average_review_score"),
        (F.avg(F.col("es_tarde").cast("double")) * 100).alias("late_delivery_rate"),
        F.avg("dias_retraso").alias("average_delivery_delay"),
        F.avg(F.when(F.col("dias_retraso") > 0, F.col("dias_retraso"))).alias("average_late_days"),
        F.coalesce(F.sum(F.when(score <= 3, paid)), F.lit(0.0)).alias("revenue_at_risk"),
        F.avg(paid).alias("average_order_value"),
    )


def kpi_exploration(df: DataFrame) -> DataFrame:
    """KPIs of the delivered orders with the exploration's denominators.

    Rates of satisfaction and risk are over rated orders; the late rate counts
    an order without a delivery date as late and is over all delivered orders,
    as is the order value.  Needs review_score, delivered_on_time, dias_retraso
    and payment_value of delivered orders.
    """
    score, paid, delay = F.col("review_score"), F.col("payment_value"), F.col("dias_retraso")
    rated = F.nullif(F.count(score).cast("double"), F.lit(0.0))
    return df.agg(
        F.count("*").alias("orders"),
        (F.count_if(score >= 4) / rated * 100).alias("customer_satisfaction_rate"),
        (F.count_if(score <= 3) / rated * 100).alias("unsatisfied_rate"),
        F.avg(score).alias("average_review_score"),
        (F.count_if(F.col("delivered_on_time") == 0) / F.nullif(F.count("*").cast("double"), F.lit(0.0)) * 100).alias(
            "late_delivery_rate"
        ),
        F.avg(F.when(delay > 0, delay)).alias("average_delay_days"),
        F.coalesce(F.sum(F.when(score <= 3, paid)), F.lit(0.0)).alias("revenue_at_risk"),
        F.avg(paid).alias("average_order_value"),
    )


def kpi_by_dimension(df: DataFrame, dims: Sequence[str], score: str = "review_score") -> DataFrame:
    """Mean score per value of several dimensions, in long form and one scan."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])
    )
    return (
        df.select(pairs.alias("_p"), F.col(score).alias("_s"))
        .where("_p.value IS NOT NULL")
        .groupBy(F.col("_p.dimension").alias("dimension"), F.col("_p.value").alias("value"))
        .agg(F.avg("_s").alias("mean_score"), F.count("*").alias("orders"))
    )


def business_baseline(df: DataFrame) -> DataFrame:
    """The nine headline figures of the delivered orders."""
    pct = lambda c: F.avg(F.col(c).cast("double")) * 100
    return df.agg(
        F.count("*").alias("orders"),
        F.avg("review_score").alias("mean_score"),
        pct("satisfecho").alias("pct_satisfied"),
        pct("delivered_on_time").alias("pct_on_time"),
        F.avg("dias_retraso").alias("mean_delay_days"),
        F.avg("dias_entrega").alias("mean_delivery_days"),
        F.avg("total_price").alias("mean_price"),
        F.avg("total_freight_value").alias("mean_freight"),
        pct("tiene_comentario").alias("pct_with_comment"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, one row each."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = []
    for c in columns:
        v = F.col(c).cast("double")
        q = [F.lit(x).cast("double") for x in quartiles[c]]
        rows.append(
            F.struct(
                F.lit(c).alias("feature"), F.count(v).alias("n"), F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
                q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), F.max(v).alias("max"),
            )
        )
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def describe_by(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Describe one column per group."""
    v = F.col(value).cast("double")
    shape = df.groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    )
    quartiles = quantiles_by_group(df, by, value, [0.25, 0.5, 0.75]).withColumnsRenamed(
        {"q0": "q25", "q1": "q50", "q2": "q75"}
    )
    return shape.join(quartiles, list(by), "left")


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the smallest on ties, as one long table."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    counts = (
        df.select(pairs.alias("p"))
        .where("p.value IS NOT NULL")
        .groupBy(F.col("p.feature").alias("feature"), F.col("p.value").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    return counts.groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"), F.max("n").alias("n")
    )


def date_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"),
        F.date_format(F.min(ts), "yyyy-MM-dd HH:mm:ss").alias("first"),
        F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss").alias("last"),
        # a set of years is a handful of values
        F.concat_ws(",", F.array_sort(F.collect_set(F.year(ts).cast("string")))).alias("years"),
    )


def pearson(a: Column, b: Column) -> Column:
    """Pearson r over rows where both sides are known; missing for a constant side."""
    x, y = a.cast("double"), b.cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def correlations(df: DataFrame, columns: Sequence[str], drop_missing: bool = False) -> DataFrame:
    """Pearson r of each pair (a before b in the list).

    Pairs with a missing side are skipped pair by pair, or whole rows are when
    ``drop_missing`` is set.  A constant column gives a missing r.  Complete
    columns share one Gram matrix; only pairs with an incomplete column are
    aggregated on their own.
    """
    source = df.dropna(subset=list(columns)) if drop_missing else df
    values = source.select(*[ex.nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    told = per_column(
        values, [F.col(c) for c in columns], F.count("*").alias("n"), F.count("v").alias("known"), F.avg("v").alias("mean"),
        F.min("v").alias("low"), F.max("v").alias("high"),
    )
    of = {c: told[i] for i, c in enumerate(columns) if i in told}
    gappy = {c for c, r in of.items() if r["known"] < r["n"]}
    varied = [c for c, r in of.items() if r["n"] > 1 and c not in gappy and r["low"] < r["high"]]
    known: dict[tuple[str, str], float | None] = {}
    if len(varied) > 1:
        centred = values.select(*[(F.col(c) - F.lit(of[c]["mean"])).alias(c) for c in varied])
        vectors = VectorAssembler(inputCols=varied, outputCol="v").transform(centred).select("v")
        matrix = Correlation.corr(vectors, "v").first()[0].toArray()
        known |= {
            (varied[i], varied[j]): float(matrix[i][j]) for i, j in combinations(range(len(varied)), 2)
        }
    left = [p for p in combinations(columns, 2) if gappy & set(p)]
    if left:
        found = values.agg(*[pearson(F.col(a), F.col(b)) for a, b in left]).first()
        known |= dict(zip(left, found))
    rows = [(a, b, known.get((a, b))) for a, b in combinations(columns, 2)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def correlation_with(df: DataFrame, target: str, columns: Sequence[str], drop_missing: bool = False) -> DataFrame:
    source = df.dropna(subset=[target, *columns]) if drop_missing else df
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            pearson(F.col(c), F.col(target)).alias("r"),
        )
        for c in columns
    ]
    return source.agg(F.array(*rows).alias("m")).select(F.inline("m"))


def class_profile(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Mean per class, their percent difference, min, max and std per feature."""
    rows = []
    for c in columns:
        v = F.col(c).cast("double")
        m0 = F.avg(F.when(F.col(label) == 0, v))
        m1 = F.avg(F.when(F.col(label) == 1, v))
        rows.append(
            F.struct(
                F.lit(c).alias("feature"), m0.alias("mean_0"), m1.alias("mean_1"),
                ((m0 - m1) / (F.abs(m1) + F.lit(1e-9)) * 100).alias("diff_pct"),
                F.min(v).alias("min"), F.max(v).alias("max"), F.stddev_samp(v).alias("std"),
            )
        )
    return df.agg(F.array(*rows).alias("m")).select(F.inline("m"))


def class_histogram(df: DataFrame, label: str, column: str, bins: int = 39) -> DataFrame:
    """Density per class over equal bins from the lower 1% to the upper 99%.

    Bounds are the outermost of the per-class percentiles; values outside are
    not counted, the top bin includes its upper edge.
    """
    v = F.col(column).cast("double")
    bounds = exact_quantiles(
        df, {str(k): F.when(F.col(label) == k, v) for k in (0, 1)}, [0.01, 0.99]
    )
    present = [b for b in bounds.values() if b[0] is not None]
    if not present:
        return df.select(F.col(label).alias("class"), F.lit(0).alias("bin")).where(F.lit(False)).groupBy(
            "class", "bin"
        ).agg(F.count("*").alias("n"), F.lit(0.0).alias("density"))
    return value_histogram(df, column, min(b[0] for b in present), max(b[1] for b in present), bins, label)


def value_histogram(
    df: DataFrame, column: str, low: float, high: float, bins: int, label: str
) -> DataFrame:
    """Counts and density per class over equal bins of a given range."""
    v = F.col(column).cast("double")
    width = (high - low) / bins
    binned = df.where(v.between(low, high)).select(
        F.col(label).alias("class"),
        F.least(F.width_bucket(v, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins)).cast("int").alias("bin"),
    )
    counts = binned.groupBy("class", "bin").agg(F.count("*").alias("n"))
    inside = F.sum("n").over(W.partitionBy("class"))
    return counts.withColumn("density", ex.ratio(F.col("n").cast("double"), inside * F.lit(width)))


def hit_rate_by_class(df: DataFrame, label: str, correct: str) -> DataFrame:
    return df.groupBy(label).agg(
        F.count("*").alias("total"),
        F.sum(correct).alias("correctos"),
        F.avg(F.col(correct).cast("double")).alias("tasa_acierto"),
    )


