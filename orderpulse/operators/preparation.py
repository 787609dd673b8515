"""Time split, target encoding, scaling, folds and class weights.

Everything fitted is fitted on the training rows only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators.arrays import per_column

# Split names and cut-off dates (inclusive at midnight).
SPLITS = ("train", "val", "backtest", "live")
CUTOFFS = ("2017-12-31", "2018-03-31", "2018-06-30")
SEED = 2357
ENCODED = ("product_category_name_english",)

# Rows of one range of the fold order, and digits of the digest that place a row.
RANGE_ROWS, DIGITS = 50_000, 12


def temporal_split(
    df: DataFrame, ts: str = "order_purchase_timestamp", cutoffs: Sequence[str] = CUTOFFS, out: str = "split"
) -> DataFrame:
    """Name the period of each row; a cut-off date ends at its midnight.

    Rows without a date belong to no period and get a missing split.
    """
    when = F.col(ts)
    kind = dict(df.dtypes)[ts]
    limit = [F.lit(c).cast(kind if kind.startswith("timestamp") else "timestamp") for c in cutoffs]
    period = (
        F.when(when <= limit[0], SPLITS[0])
        .when(when <= limit[1], SPLITS[1])
        .when(when <= limit[2], SPLITS[2])
        .when(when > limit[2], SPLITS[3])
    )
    return df.withColumn(out, period)


def split_summary(
    df: DataFrame, ts: str = "order_purchase_timestamp", label: str = "satisfecho", split: str = "split"
) -> DataFrame:
    return df.where(F.col(split).isNotNull()).groupBy(split).agg(
        F.count("*").alias("n_rows"),
        ex.year_month(F.min(ts)).alias("first_month"),
        ex.year_month(F.max(ts)).alias("last_month"),
        F.avg(F.col(label).cast("double")).alias("target_rate"),
    )


def target_encode(
    df: DataFrame,
    columns: Sequence[str] = ENCODED,
    label: str = "satisfecho",
    train: Column | None = None,
) -> DataFrame:
    """Replace each category by the mean label of its training rows.

    Categories the training rows lack, and missing ones, get the overall mean.
    """
    fit_rows = df.where(train if train is not None else F.col("split") == "train")
    target = F.avg(F.col(label).cast("double"))
    overall = fit_rows.agg(target).scalar()
    out = df
    for c in [c for c in columns if c in df.columns]:
        means = (
            fit_rows.where(F.col(c).isNotNull()).groupBy(c).agg(target.alias(f"_{c}"))
        )
        out = (
            out.join(means, c, "left")
            .withColumn(f"te_{c}", F.coalesce(f"_{c}", overall))
            .drop(c, f"_{c}")
        )
    return out


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column divides by 1."""
    if not columns:
        return {}
    told = per_column(df, [F.col(c).cast("double") for c in columns], F.avg("v").alias("m"), F.stddev_pop("v").alias("s"))
    return {c: (told[i]["m"] or 0.0, told[i]["s"] or 1.0) if i in told else (0.0, 1.0) for i, c in enumerate(columns)}


def standardize(
    df: DataFrame, columns: Sequence[str], train: Column | None = None
) -> DataFrame:
    """Centre and scale every listed column with the training mean and deviation."""
    fitted = fit_scaler(df.where(train if train is not None else F.col("split") == "train"), columns)
    return df.withColumns(
        {c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in fitted.items()}
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if ex.is_numeric(f.dataType) and f.name not in exclude]


def drop_text(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop text columns that are left over before modelling."""
    return df.drop(*[name for name, kind in df.dtypes if kind == "string" and name not in keep])


def stratified_folds(
    df: DataFrame, label: str = "satisfecho", key: str = "order_id", folds: int = 5, seed: int = SEED,
    out: str = "fold",
) -> DataFrame:
    """Shuffled folds whose sizes differ by at most one within each class.

    Rows are dealt out in the order of a seeded digest of the key.  The digest's
    leading digits cut that order into even ranges, as many as the number of
    rows asks for, so positions come from small windows plus range totals, and
    the result does not depend on how many ranges there are.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    ranges = max(1, math.ceil(df.select(key).count() / RANGE_ROWS))
    place = F.conv(F.substring("_digest", 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)
    marked = df.withColumn("_digest", digest).withColumn("_range", F.floor(place * ranges))
    totals = marked.groupBy(label, "_range").agg(F.count("*").alias("_n"))
    before = W.partitionBy(label).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(label, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = W.partitionBy(label, "_range").orderBy("_digest", key)
    local = marked.withColumn("_pos", F.row_number().over(inner) - 1)
    return (
        local.join(offsets, [label, "_range"])
        .withColumn(out, F.pmod(F.col("_pos") + F.col("_before"), F.lit(folds)).cast("int"))
        .drop("_digest", "_range", "_pos", "_before")
    )


def class_weights(df: DataFrame, label: str = "satisfecho") -> DataFrame:
    """Balanced weight n / (2 * n_class) per class, and the positive/negative ratio."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    whole = W.partitionBy()  # two rows, one per class
    total = F.sum("n").over(whole).cast("double")
    other = total - F.col("n")
    return counts.select(
        label, "n", (total / (2 * F.col("n"))).alias("weight"),
        (F.col("n") / F.nullif(other, F.lit(0.0))).alias("ratio_to_other"),
    )


def class_counts(df: DataFrame, label: str = "satisfecho") -> tuple[int, int]:
    """Rows, and rows of class 1."""
    row = df.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos")).first()
    return row["n"], row["pos"] or 0


def weight_column(
    df: DataFrame, label: str = "satisfecho", out: str = "weight", counts: tuple[int, int] | None = None
) -> DataFrame:
    """Add the balanced class weight to each row."""
    n, pos = counts or class_counts(df, label)
    by_class = {1: n / (2 * pos) if pos else 1.0, 0: n / (2 * (n - pos)) if n > pos else 1.0}
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(by_class[1])).otherwise(F.lit(by_class[0])))
