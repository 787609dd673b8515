"""Distribution shift and rank tests: stability index, KS and Mann-Whitney."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators.ordering import plain_zero, running_totals
from orderpulse.operators.quantiles import exact_quantiles

FEATURE_EPSILON = 1e-6
SCORE_EPSILON = 1e-4
PSI_WARN, PSI_ALERT = 0.10, 0.25


def _stability(counts: DataFrame, epsilon: float) -> DataFrame:
    """Index per key from (key, bin, ref, act) counts; bin -1 lies outside all bins.

    At most one row per key and bin arrives here.
    """
    per_key = W.partitionBy("key")
    shares = counts.withColumns(
        {"n_ref": F.sum("ref").over(per_key).cast("double"), "n_act": F.sum("act").over(per_key).cast("double")}
    ).where("bin >= 0")
    share = lambda c, n: F.when(F.col(c) == 0, F.lit(epsilon)).otherwise(F.col(c) / F.nullif(n, F.lit(0.0)))
    e, a = share("ref", F.col("n_ref")), share("act", F.col("n_act"))
    # a side without any value counts as no shift
    term = F.when((F.col("n_ref") > 0) & (F.col("n_act") > 0), (a - e) * F.ln(a / e)).otherwise(F.lit(0.0))
    return shares.groupBy("key").agg(F.sum(term).alias("psi"))


def _binned_counts(
    values: DataFrame, keys: Sequence[str], splits: Sequence[Sequence[float]], outer: bool
) -> DataFrame:
    """Count both sides per (key, bin) in one scan over columns v0, v1, ...

    ``_r`` and ``_a`` flag the sides.  The outermost ranges are bins of their own
    when ``outer`` is set and lie outside all bins (bin -1) otherwise.
    """
    cuts = [np.array(x, float) for x in splits]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [np.zeros((2, len(cut) - 1), np.int64) for cut in cuts]
        for batch in batches:
            sides = [batch.column(k).to_numpy() for k in (0, 1)]
            for i, cut in enumerate(cuts):
                v = batch.column(2 + i).to_numpy(zero_copy_only=False).astype(float)
                known = ~np.isnan(v)
                # the last range is closed
                at = np.minimum(np.searchsorted(cut, v[known], side="right") - 1, len(cut) - 2)
                for counts, side in zip(own[i], sides):
                    counts += np.bincount(at, side[known], len(counts)).astype(np.int64)
        for i, counts in enumerate(own):
            seen = np.flatnonzero(counts.any(0))
            bins = seen if outer else np.where((seen > 0) & (seen < counts.shape[1] - 1), seen, -1)
            arrays = [np.full(len(seen), i, np.int32), bins.astype(np.int32), *counts[:, seen]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["i", "bin", "ref", "act"])

    told = values.select("_r", "_a", *[f"v{i}" for i in range(len(keys))]).mapInArrow(run, "i int, bin int, ref long, act long")
    key = F.element_at(F.array(*[F.lit(k) for k in keys]), F.col("i") + 1)
    return told.groupBy("i", "bin").agg(F.sum("ref").alias("ref"), F.sum("act").alias("act")).withColumn("key", key).drop("i")


def feature_psi(
    df: DataFrame, features: Sequence[str], reference: Column, actual: Column, bins: int = 10, digits: int | None = 4
) -> DataFrame:
    """Stability index per feature between two row sets of one table.

    Bins are the distinct reference percentiles with finite ends: values beyond
    them stay out of the bins but keep counting in the totals.  A feature with
    fewer than two edges has index 0.
    """
    probs = [i / bins for i in range(bins + 1)]
    edges = {
        f: sorted(set(q)) if q[0] is not None else []
        for f, q in exact_quantiles(df.where(reference), list(features), probs).items()
    }
    usable = [f for f in features if len(edges[f]) >= 2]
    flat = df.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    if not usable:
        return flat.withColumn("psi", F.lit(0.0))
    side = {"_r": ex.flag(reference), "_a": ex.flag(actual)}
    values = df.select(
        *[c.alias(n) for n, c in side.items()],
        *[F.col(f).cast("double").alias(f"v{i}") for i, f in enumerate(usable)],
    )
    # below the first edge, the bins (the last one closed), above the last edge
    splits = [[-math.inf, *edges[f][:-1], math.nextafter(edges[f][-1], math.inf), math.inf] for f in usable]
    index = _stability(_binned_counts(values, usable, splits, outer=False), FEATURE_EPSILON)
    value = F.coalesce("psi", F.lit(0.0))
    return flat.join(index.withColumnRenamed("key", "feature"), "feature", "left").select(
        "feature", (F.round(value, digits) if digits is not None else value).alias("psi")
    )


def score_psi(
    df: DataFrame, proba: str, period: str, reference: str, others: Sequence[str], buckets: int = 10
) -> DataFrame:
    """Stability index of the score per period against a reference period."""
    probs = [i / buckets for i in range(1, buckets)]
    score = F.col(proba).cast("double")
    found = exact_quantiles(df.where(F.col(period) == reference), {"s": score}, probs)["s"]
    # an edge that repeats opens an empty bin on both sides, which adds nothing
    splits = [-math.inf, *sorted({e for e in found if e is not None}), math.inf]
    if len(splits) < 3:
        splits = [-math.inf, 0.0, math.inf]
    out = None
    for other in others:
        values = df.select(
            ex.flag(F.col(period) == reference).alias("_r"), ex.flag(F.col(period) == other).alias("_a"),
            plain_zero(score).alias("v0"),
        )
        one = _stability(_binned_counts(values, [other], [splits], outer=True), SCORE_EPSILON)
        out = one if out is None else out.unionByName(one)
    band = (
        F.when(F.col("psi") >= PSI_ALERT, "critico").when(F.col("psi") >= PSI_WARN, "alerta").otherwise("estable")
    )
    return out.select(F.col("key").alias(period), "psi", band.alias("band"))


def ks_statistics(df: DataFrame, value: str, period: str, reference: str, others: Sequence[str]) -> DataFrame:
    """Largest gap between cumulative shares, per period against the reference."""
    names = [reference, *others]
    sums = {f"p{i}": ex.flag(F.col(period) == p) for i, p in enumerate(names)}
    totals = running_totals(df.where(F.col(period).isin(names)), value, sums)
    share = [F.col(f"p{i}_cum") / F.nullif(F.col(f"p{i}_all"), F.lit(0.0)) for i in range(len(names))]
    rows = [
        F.struct(F.lit(p).alias(period), F.max(F.abs(share[0] - share[i])).alias("ks"))
        for i, p in enumerate(names) if i
    ]
    return totals.agg(F.array(*rows).alias("m")).select(F.inline("m"))


#: Terms of the series and of the continued fraction below; more than doubles can tell apart.
TAIL_TERMS = 80


def lower_tail(z: Column) -> Column:
    """Standard normal distribution function, for the one row per test.

    Near zero by the series of the error function, whose terms are all positive;
    beyond, by the continued fraction of its complement.
    """
    x = F.abs(z) / math.sqrt(2)
    terms = F.transform(F.sequence(F.lit(0), F.lit(TAIL_TERMS)), lambda n: n.cast("double"))
    start = F.struct(F.lit(0.0).alias("sum"), x.alias("term"))
    step = lambda acc, n: F.struct(
        (acc["sum"] + acc["term"]).alias("sum"), (acc["term"] * 2 * x * x / (2 * n + 3)).alias("term")
    )
    series = F.aggregate(terms, start, step, lambda acc: acc["sum"])
    near = 1 - 2 / math.sqrt(math.pi) * F.exp(-x * x) * series
    fraction = F.aggregate(F.reverse(terms), x, lambda f, n: x + (n + 1) / 2 / f)
    far = F.exp(-x * x) / (math.sqrt(math.pi) * fraction)
    upper = F.when(x < 3, near).otherwise(far) / 2
    return F.when(~F.isnan(z), F.when(z < 0, upper).otherwise(1 - upper))


def mann_whitney(df: DataFrame, value: str, first: Column, second: Column) -> DataFrame:
    """U of the first sample and the one-sided 'less' p-value.

    Normal approximation with tie and continuity correction.
    """
    totals = running_totals(df, value, {"a": ex.flag(first), "b": ex.flag(second)})
    t = F.col("a") + F.col("b")
    before = F.col("a_cum") + F.col("b_cum") - t
    stats = totals.agg(
        F.sum(F.col("a") * (before + (t + 1) / 2)).alias("r1"),
        F.max("a_all").alias("n1"),
        F.max("b_all").alias("n2"),
        F.sum(t * t * t - t).alias("ties"),
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    spread = n1 * n2 / 12 * ((n + 1) - F.col("ties") / F.nullif(n * (n - 1), F.lit(0.0)))
    u = stats.withColumn("u", F.col("r1") - n1 * (n1 + 1) / 2)
    z = (F.col("u") - n1 * n2 / 2 + F.lit(0.5)) / F.nullif(F.sqrt(spread), F.lit(0.0))
    return u.withColumn("z", z).select(
        "u", n1.cast("long").alias("n1"), n2.cast("long").alias("n2"), "z", lower_tail(F.col("z")).alias("p_less")
    )
