"""Running totals, ranks and positions over a whole table, without one big sort.

Spark runs a window with no partition key in a single task.  The helpers here
cut the value axis into ranges of similar row counts instead:

* ``running_totals`` first collapses rows to distinct values, so a value held
  by a third of all rows becomes one row, then adds up within each range and
  adds the totals of the ranges before it.
* ``with_lower`` gives each distinct value a look at the one below it.
* ``positions`` numbers every row under a total order.  The order must end in a
  unique key, so a range never has to hold all copies of a hot value.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderpulse.sources.staging import stage

#: Rows that one range, and so one task, should hold.
RANGE_ROWS = 500_000


def range_count(df: DataFrame) -> int:
    """Ranges to cut the rows into, as many as their number asks for."""
    return max(1, math.ceil(df.count() / RANGE_ROWS))


def in_ranges(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Cut the rows into ranges of an order, numbered by ``_range``.

    The rows are written before they are counted, sampled and cut, so what lies
    above them runs once; they are written again with their range, which fixes
    it for every later reader.
    """
    rows = stage(df, name)
    cut = rows.repartitionByRange(range_count(rows), *order)
    return stage(cut.withColumn("_range", F.spark_partition_id()), f"{name}-ranges")


def plain_zero(value: Column) -> Column:
    """Double with -0.0 folded into 0.0, so equal numbers group together."""
    return value.cast("double") + F.lit(0.0)


def running_totals(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """One row per (by, distinct value) with sums and their running totals.

    For each name s in ``sums`` the result has ``s`` (total at this value),
    ``s_cum`` (up to and including it, in value order) and ``s_all`` (the whole
    group).  Rows with a missing or NaN value are left out.
    """
    keys = list(by)
    names = list(sums)
    clean = df.withColumn(value, plain_zero(F.col(value))).where(
        F.col(value).isNotNull() & ~F.isnan(value)
    )
    # cast early: counts near 1e11 squared overflow long arithmetic downstream
    summed = clean.groupBy(*keys, value).agg(*[F.sum(sums[s]).cast("double").alias(s) for s in names])
    distinct = in_ranges(summed, [F.col(c) for c in (*keys, value)], "values")
    totals = distinct.groupBy(*keys, "_range").agg(*[F.sum(s).alias(f"_{s}") for s in names])
    # one row per range and group from here on
    order = F.col("_range").desc() if descending else F.col("_range").asc()
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    offsets = totals.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0.0)).alias(f"_{s}_before") for s in names],
        *[F.sum(f"_{s}").over(whole).alias(f"{s}_all") for s in names],
    )
    inner_order = F.col(value).desc() if descending else F.col(value).asc()
    inner = W.partitionBy(*keys, "_range").orderBy(inner_order).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    local = distinct.withColumns({f"{s}_cum": F.sum(s).over(inner) for s in names})
    joined = local.join(offsets, [*keys, "_range"])
    return joined.select(
        *keys,
        value,
        *names,
        *[(F.col(f"{s}_cum") + F.col(f"_{s}_before")).alias(f"{s}_cum") for s in names],
        *[f"{s}_all" for s in names],
    )


def positions(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add a 1-based row number ``pos``, group size ``n`` and running sums.

    ``order`` must be a total order (end it with a unique key).  Rows are range
    partitioned on (by, order) and written to the shared folder, so the range
    each row falls in is fixed before totals per range are taken.
    """
    keys = list(by)
    extra = dict(sums or {})
    flat = df.withColumns({f"_s_{s}": c.cast("double") for s, c in extra.items()})
    fixed = in_ranges(flat, [*[F.col(k) for k in keys], *order], "positions")
    totals = fixed.groupBy(*keys, "_range").agg(
        F.count("*").alias("_n"), *[F.sum(f"_s_{s}").alias(f"_t_{s}") for s in extra]
    )
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.sum("_n").over(W.partitionBy(*keys)).alias("n"),
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0.0)).alias(f"_b_{s}") for s in extra],
        *[F.sum(f"_t_{s}").over(W.partitionBy(*keys)).alias(f"{s}_all") for s in extra],
    )
    inner = W.partitionBy(*keys, "_range").orderBy(*order)
    upto = inner.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = fixed.withColumns(
        {"pos": F.row_number().over(inner)}
        | {f"{s}_cum": F.sum(f"_s_{s}").over(upto) for s in extra}
    )
    joined = local.join(offsets, [*keys, "_range"])
    return joined.select(
        *df.columns,
        (F.col("pos") + F.col("_n_before")).cast("long").alias("pos"),
        F.col("n").cast("long").alias("n"),
        *[(F.col(f"{s}_cum") + F.col(f"_b_{s}")).alias(f"{s}_cum") for s in extra],
        *[f"{s}_all" for s in extra],
    )


def with_lower(totals: DataFrame, by: Sequence[str], value: str, columns: Sequence[str]) -> DataFrame:
    """Add ``lower``: a struct of columns at the next lower value of the group, missing at its lowest.

    Within a range a window finds it; the lowest row of a range takes it from
    the top of the nearest range below that has rows of the group.
    """
    keys = list(by)
    ranged = in_ranges(totals, [F.col(c) for c in (*keys, value)], "neighbours")
    own = F.struct(*columns)
    tops = ranged.groupBy(*keys, "_range").agg(F.max_by(own, F.col(value)).alias("_top"))
    below = F.lag("_top").over(W.partitionBy(*keys).orderBy("_range"))
    tops = tops.select(*keys, "_range", below.alias("_below"))
    inner = W.partitionBy(*keys, "_range").orderBy(value)
    found = ranged.withColumn("_own", F.lag(own).over(inner)).join(tops, [*keys, "_range"])
    return found.withColumn("lower", F.coalesce("_own", "_below")).drop("_own", "_below", "_range")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The first row of each key under a total order.

    Spark keeps only each task's best row per key before it shuffles, so a hot
    key sends one row per task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def running_max(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, out: str) -> DataFrame:
    """Best value so far within each group (a handful of trials per group)."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(out, F.max(value).over(w))


def seeded_sample(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """At most ``size`` rows in a seeded order; the same rows on every run."""
    shuffled = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(shuffled, key).limit(size)
