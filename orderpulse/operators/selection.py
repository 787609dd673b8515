"""Feature filters and the champion rule of stepwise selection.

Each filter returns ``(kept, removed)`` name lists; only per-feature numbers
ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators import aggregates as ag, drift, quality as qa
from orderpulse.operators.metrics import rank_metrics

# Thresholds each step tries, and the accepted loss of AUC.
MISSING_THRESHOLDS = (0.10, 0.15)
PSI_THRESHOLD = 0.20
PSI_BINS = 10
CORRELATION_THRESHOLDS = (0.80, 0.90, 0.95, 0.99)
UNIVARIATE_THRESHOLDS = (0.01, 0.02, 0.05)
VARIANCE_THRESHOLD = 0.01
TOP_IMPORTANCES = (20, 25, 30)
AUC_TOLERANCE = 0.005

Names = list[str]


def _partition(features: Sequence[str], removed: set[str]) -> tuple[Names, Names]:
    return [f for f in features if f not in removed], [f for f in features if f in removed]


def nonconstant(df: DataFrame, features: Sequence[str]) -> Names:
    """Features with at least two different non-missing values."""
    if not features:
        return []
    row = df.agg(*[(F.min(f) < F.max(f)).alias(f"c{i}") for i, f in enumerate(features)]).first()
    return [f for i, f in enumerate(features) if row[i]]


def by_missing(
    df: DataFrame, features: Sequence[str], threshold: float, shares: Mapping[str, float] | None = None
) -> tuple[Names, Names]:
    """Drop features that miss more than a share of the rows; ``shares`` saves a scan where they are known."""
    if not features:
        return [], []
    shares = shares or qa.missing_shares(df, features)
    return _partition(features, {f for f in features if shares[f] > threshold})


def by_psi(psi: Mapping[str, float], features: Sequence[str], threshold: float = PSI_THRESHOLD) -> tuple[Names, Names]:
    return _partition(features, {f for f in features if psi[f] > threshold})


def psi_values(
    df: DataFrame, features: Sequence[str], reference: Column, actual: Column, bins: int = PSI_BINS
) -> dict[str, float]:
    return {r["feature"]: r["psi"] for r in drift.feature_psi(df, features, reference, actual, bins).collect()}


def correlation_values(df: DataFrame, features: Sequence[str]) -> dict[tuple[str, str], float]:
    if len(features) < 2:
        return {}
    return {(r["a"], r["b"]): r["r"] for r in ag.correlations(df, features).collect() if r["r"] is not None}


def by_correlation(
    r: Mapping[tuple[str, str], float], features: Sequence[str], threshold: float
) -> tuple[Names, Names]:
    """Drop a feature that correlates with any earlier one, dropped or not."""
    order = {f: i for i, f in enumerate(features)}
    removed = {
        max(pair, key=order.__getitem__)
        for pair, value in r.items()
        if pair[0] in order and pair[1] in order and abs(value) > threshold
    }
    return _partition(features, removed)


def correlated_features(df: DataFrame, features: Sequence[str], threshold: float) -> DataFrame:
    """The same rule as a table: the worst earlier partner and whether the feature goes."""
    pairs = ag.correlations(df, features)
    worst = pairs.groupBy(F.col("b").alias("feature")).agg(F.max(F.abs("r")).alias("max_abs_r"))
    return worst.withColumn("removed", F.coalesce(F.col("max_abs_r") > threshold, F.lit(False)))


def univariate_auc(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rank AUC of each raw feature as a score, in long form and one pass."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    )
    long = df.select(F.col(label).alias("label"), pairs.alias("p")).select("label", "p.feature", "p.value")
    ranked = rank_metrics(long, ["feature"], "label", "value").select("feature", "auc")
    return ranked


def by_univariate(aucs: Mapping[str, float | None], features: Sequence[str], threshold: float) -> tuple[Names, Names]:
    """Drop features whose AUC is missing or closer to one half than the threshold."""
    weak = {f for f in features if aucs.get(f) is None or abs(aucs[f] - 0.5) < threshold}
    return _partition(features, weak)


def variances(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Population variance with missing values read as 0."""
    rows = [
        F.struct(F.lit(f).alias("feature"), F.var_pop(F.coalesce(F.col(f).cast("double"), F.lit(0.0))).alias("variance"))
        for f in features
    ]
    return df.agg(F.array(*rows).alias("m")).select(F.inline("m"))


def by_variance(
    df: DataFrame, features: Sequence[str], threshold: float = VARIANCE_THRESHOLD
) -> tuple[Names, Names]:
    if not features:
        return [], []
    low = {r["feature"] for r in variances(df, features).collect() if not r["variance"] > threshold}
    return _partition(features, low)


def by_importance(
    importances: Mapping[str, float], features: Sequence[str], top: int
) -> tuple[Names, Names]:
    """Keep the most important features, in that order; short lists pass unchanged."""
    if len(features) <= top:
        return list(features), []
    ranked = sorted(features, key=lambda f: -importances[f])
    return ranked[:top], ranked[top:]


def winners(candidates: DataFrame, tolerance: float = AUC_TOLERANCE) -> DataFrame:
    """Mark the winning candidate of each step.

    Needs paso, ord (order of trial), n_features, auc_val and base_auc.  A
    candidate counts when it keeps a feature, has an AUC and loses at most the
    tolerance; the highest AUC wins, the earlier candidate on ties.  A step
    without a valid candidate has no winner.
    """
    valid = (
        F.col("auc_val").isNotNull()
        & (F.col("n_features") > 0)
        & (F.col("auc_val") >= F.col("base_auc") - F.lit(tolerance))
    )
    best = F.min(F.when(valid, F.struct(-F.col("auc_val"), F.col("ord")))).over(W.partitionBy("paso"))
    return candidates.withColumn(
        "elegido",
        F.coalesce(valid & (best == F.struct(-F.col("auc_val"), F.col("ord"))), F.lit(False)),
    )


def pick(aucs: Sequence[float | None], sizes: Sequence[int], base: float | None, tolerance: float = AUC_TOLERANCE) -> int | None:
    """Index of the winning candidate of one step, or None."""
    if base is None:
        base = float("-inf")
    valid = [i for i, a in enumerate(aucs) if a is not None and sizes[i] > 0 and a >= base - tolerance]
    return max(valid, key=lambda i: aucs[i]) if valid else None


def removed_detail(steps: DataFrame) -> DataFrame:
    """One row per feature a candidate removed; needs the features_eliminadas array."""
    return steps.select(
        "paso", "metodo", "threshold", F.explode("features_eliminadas").alias("feature_eliminada"),
        F.col("elegido").alias("paso_elegido"),
    )


def nonconstant_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(F.lit(f).alias("feature"), ex.flag(F.min(f) < F.max(f)).alias("varies")) for f in features
    ]
    return df.agg(F.array(*rows).alias("m")).select(F.inline("m"))
