"""Linear scoring and exact linear attributions from a coefficient mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from orderpulse.functions import expressions as ex


def linear_logit(coefficients: Mapping[str, float], intercept: float = 0.0):
    terms = [F.lit(float(w)) * F.col(f) for f, w in coefficients.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))


def linear_score(
    df: DataFrame, coefficients: Mapping[str, float], intercept: float = 0.0, threshold: float = 0.5
) -> DataFrame:
    """Probability of class 1 and the 0/1 prediction of a linear model."""
    proba = ex.sigmoid(linear_logit(coefficients, intercept))
    return df.withColumn("proba", proba).withColumn("pred", ex.flag(F.col("proba") >= threshold))


def background_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.col(f).cast("double")) for f in features]).first()
    return {f: row[i] or 0.0 for i, f in enumerate(features)}


def linear_attributions(
    df: DataFrame,
    coefficients: Mapping[str, float],
    intercept: float = 0.0,
    background: DataFrame | None = None,
) -> DataFrame:
    """``phi_<feature>`` = weight * (value - background mean), plus the base value.

    The mean of the whole background is used; base plus all phi is the logit.
    """
    means = background_means(background if background is not None else df, list(coefficients))
    base = intercept + sum(w * means[f] for f, w in coefficients.items())
    phi = {
        f"phi_{f}": F.lit(float(w)) * (F.col(f).cast("double") - F.lit(means[f])) for f, w in coefficients.items()
    }
    return df.withColumns(phi).withColumn("base_value", F.lit(float(base)))


def top_features(attributed: DataFrame, features: Sequence[str], top: int | None = 5) -> DataFrame:
    """Mean absolute attribution per feature, ranked (one row per feature)."""
    rows = [
        F.struct(F.lit(f).alias("feature"), F.avg(F.abs(f"phi_{f}")).alias("mean_abs_shap")) for f in features
    ]
    long = attributed.agg(F.array(*rows).alias("m")).select(F.inline("m"))
    ordered = long.orderBy(F.col("mean_abs_shap").desc(), "feature")
    return ordered.limit(top) if top else ordered


def explain_row(attributed: DataFrame, features: Sequence[str], key: str, value: object) -> DataFrame:
    """Ordered contributions of one row."""
    rows = [
        F.struct(
            F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"), F.col(f"phi_{f}").alias("phi")
        )
        for f in features
    ]
    return (
        attributed.where(F.col(key) == F.lit(value))
        .select(key, "base_value", F.inline(F.array(*rows)))
        .orderBy(F.abs("phi").desc(), "feature")
    )


def importance_delta(base: DataFrame, tuned: DataFrame, top: int = 15) -> DataFrame:
    """Importances side by side with their percent change, the largest tuned first."""
    joined = base.select("feature", F.col("importance").alias("base")).join(
        tuned.select("feature", F.col("importance").alias("tuned")), "feature"
    )
    change = (F.col("tuned") - F.col("base")) / F.nullif(F.abs("base"), F.lit(0.0)) * 100
    return joined.withColumn("delta_pct", change).orderBy(F.col("tuned").desc(), "feature").limit(top)
