"""Evaluation of binary scores: label in {0, 1}, probability of class 1.

Every function takes grouping columns ``by`` (period, model, ...), so all
groups are measured in the same pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators.ordering import plain_zero, positions, running_totals, with_lower

DECILES = 10

# Label texts in scored exports.
SATISFIED, UNSATISFIED = "Satisfecho", "Insatisfecho"


def spaced(start: float, stop: float, num: int) -> list[float]:
    """Evenly spaced thresholds including both ends."""
    step = (stop - start) / (num - 1)
    return [start + i * step for i in range(num - 1)] + [stop]


# The three threshold grids.
GRID_BASELINE = spaced(0.01, 0.99, 200)
GRID_BACKTEST = spaced(0.05, 0.95, 181)
GRID_NOTEBOOK = [0.1 + i * 0.02 for i in range(40)]


def predict(df: DataFrame, threshold: float = 0.5, proba: str = "proba", out: str = "pred") -> DataFrame:
    return df.withColumn(out, ex.flag(F.col(proba) >= F.lit(threshold)))


def _cells(pred: Column, label: str) -> dict[str, Column]:
    y = F.col(label)
    return {
        "tn": F.count_if((y == 0) & (pred == 0)),
        "fp": F.count_if((y == 0) & (pred == 1)),
        "fn": F.count_if((y == 1) & (pred == 0)),
        "tp": F.count_if((y == 1) & (pred == 1)),
    }


def confusion(
    df: DataFrame, by: Sequence[str] = (), threshold: float = 0.5, label: str = "label", proba: str = "proba"
) -> DataFrame:
    """tn, fp, fn, tp per group."""
    pred = ex.flag(F.col(proba) >= F.lit(threshold))
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(pred, label).items()])


def confusion_long(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The four cells as rows with counts and percent of the group."""
    total = (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).cast("double")
    rows = [
        F.struct(
            F.lit(real).alias("real"), F.lit(pred).alias("pred"), F.col(c).alias("n"),
            (F.col(c) / F.nullif(total, F.lit(0.0)) * 100).alias("pct"),
        )
        for c, real, pred in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ]
    return conf.select(*by, F.inline(F.array(*rows)))


def _doubles() -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))  # type: ignore[return-value]


def class_scores() -> dict[str, Column]:
    """Precision, recall and F1 per class, macro F1, accuracy and support from the cells."""
    tn, fp, fn, tp = _doubles()
    f1_0 = ex.safe_div(2 * tn, 2 * tn + fn + fp)
    f1_1 = ex.safe_div(2 * tp, 2 * tp + fn + fp)
    return {
        "prec_0": ex.safe_div(tn, tn + fn),
        "recall_0": ex.safe_div(tn, tn + fp),
        "f1_0": f1_0,
        "prec_1": ex.safe_div(tp, tp + fp),
        "recall_1": ex.safe_div(tp, tp + fn),
        "f1_1": f1_1,
        "f1_macro": (f1_0 + f1_1) / 2,
        "accuracy": ex.safe_div(tn + tp, tn + fp + fn + tp),
        "support_0": (F.col("tn") + F.col("fp")).cast("long"),
        "support_1": (F.col("fn") + F.col("tp")).cast("long"),
    }


def imbalance_scores() -> dict[str, Column]:
    """MCC, kappa, balanced accuracy and the geometric mean of recalls from the cells."""
    tn, fp, fn, tp = _doubles()
    n = tn + fp + fn + tp
    spread = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    chance = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / F.nullif(n * n, F.lit(0.0))
    rec0, rec1 = ex.safe_div(tn, tn + fp), ex.safe_div(tp, tp + fn)
    return {
        "mcc": ex.safe_div(tp * tn - fp * fn, spread),
        "kappa": ex.safe_div(ex.safe_div(tn + tp, n) - chance, 1 - chance),
        "bal_acc": (rec0 + rec1) / 2,
        "gmean": F.sqrt(rec0 * rec1),
    }


def class_metrics(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return conf.select(*by, *[c.alias(n) for n, c in class_scores().items()])


def imbalance_metrics(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return conf.select(*by, *[c.alias(n) for n, c in imbalance_scores().items()])


def brier(df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba") -> DataFrame:
    gap = F.col(proba) - F.col(label)
    return df.groupBy(*by).agg(F.avg(gap * gap).alias("brier"))


def score_totals(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba"
) -> DataFrame:
    """Positives and negatives per distinct score with their running totals.

    The rank metrics and both curves follow from this table; stage it and pass
    it as ``totals`` when several of them are wanted.
    """
    return running_totals(
        df, proba, {"pos": ex.flag(F.col(label) == 1), "neg": ex.flag(F.col(label) == 0)}, by=by
    )


def _rank_aggregates() -> dict[str, Column]:
    pos, neg = F.col("pos"), F.col("neg")
    below = F.col("neg_cum") - neg
    # counts at or above a score, from totals in ascending order
    tp = F.col("pos_all") - F.col("pos_cum") + pos
    fp = F.col("neg_all") - F.col("neg_cum") + neg
    pairs = F.nullif(F.max("pos_all") * F.max("neg_all"), F.lit(0.0))
    return {
        "auc": F.sum(pos * below + pos * neg / 2) / pairs,
        "avg_prec": F.coalesce(
            F.sum(tp / F.nullif(tp + fp, F.lit(0.0)) * pos) / F.nullif(F.max("pos_all"), F.lit(0.0)), F.lit(0.0)
        ),
    }


def rank_metrics(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", totals: DataFrame | None = None
) -> DataFrame:
    """Exact AUC (ties count half), Gini and step average precision; one class gives no AUC."""
    totals = totals if totals is not None else score_totals(df, by, label, proba)
    found = totals.groupBy(*by).agg(
        *[c.alias(n) for n, c in _rank_aggregates().items()]
    )
    return found.select(*by, "auc", (2 * F.col("auc") - 1).alias("gini"), "avg_prec")


def all_metrics(
    df: DataFrame, by: Sequence[str], threshold: float = 0.5, label: str = "label", proba: str = "proba",
    totals: DataFrame | None = None,
) -> DataFrame:
    """Every score of a group in one row: cells, class, imbalance, Brier and rank metrics."""
    keys = list(by) or ["_all"]
    if totals is not None and not by:
        totals = totals.withColumn("_all", F.lit(1))
    source = df if by else df.withColumn("_all", F.lit(1))
    pred = ex.flag(F.col(proba) >= F.lit(threshold))
    gap = F.col(proba) - F.col(label)
    cells = source.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[c.alias(n) for n, c in _cells(pred, label).items()],
        F.avg(gap * gap).alias("brier"),
        F.avg(F.col(label).cast("double")).alias("target_rate"),
    )
    scores = cells.withColumns(class_scores() | imbalance_scores())
    out = scores.join(rank_metrics(source, keys, label, proba, totals), keys, "left")
    return out if by else out.drop("_all")


def as_class(df: DataFrame, pos_label: int, label: str = "label", proba: str = "proba") -> DataFrame:
    """The same rows with class ``pos_label`` as 1 and its probability."""
    if pos_label == 1:
        return df
    return df.withColumns({label: 1 - F.col(label), proba: 1 - F.col(proba)})


def corners(totals: DataFrame, by: Sequence[str] = (), proba: str = "proba") -> DataFrame:
    """Totals without the scores at which a curve runs straight on: both ends stay, and every change of step."""
    seen = with_lower(totals, by, proba, ["pos", "neg"])
    turn = (F.col("lower.pos") != F.col("pos")) | (F.col("lower.neg") != F.col("neg"))
    top = (F.col("pos_cum") == F.col("pos_all")) & (F.col("neg_cum") == F.col("neg_all"))
    return seen.where(F.col("lower").isNull() | turn | top).drop("lower")


def roc_points(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", totals: DataFrame | None = None,
    pos_label: int = 1, reduced: bool = False,
) -> DataFrame:
    """False and true positive rate per distinct threshold, plus the origin.

    ``reduced`` leaves out points in the middle of a straight piece; ``totals``
    belong to the class that counts as positive.
    """
    totals = totals if totals is not None else score_totals(as_class(df, pos_label, label, proba), by, label, proba)
    totals = corners(totals, by, proba) if reduced else totals
    tp = F.col("pos_all") - F.col("pos_cum") + F.col("pos")
    fp = F.col("neg_all") - F.col("neg_cum") + F.col("neg")
    points = totals.select(
        *by,
        F.col(proba).alias("threshold"),
        (fp / F.nullif(F.col("neg_all"), F.lit(0.0))).alias("fpr"),
        (tp / F.nullif(F.col("pos_all"), F.lit(0.0))).alias("tpr"),
    )
    origin = points.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def pr_points(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", totals: DataFrame | None = None,
    pos_label: int = 1,
) -> DataFrame:
    """Precision and recall per distinct threshold, plus the closing (1, 0) point."""
    totals = totals if totals is not None else score_totals(as_class(df, pos_label, label, proba), by, label, proba)
    tp = F.col("pos_all") - F.col("pos_cum") + F.col("pos")
    fp = F.col("neg_all") - F.col("neg_cum") + F.col("neg")
    points = totals.select(
        *by,
        F.col(proba).alias("threshold"),
        (tp / F.nullif(tp + fp, F.lit(0.0))).alias("prec"),
        (tp / F.nullif(F.col("pos_all"), F.lit(0.0))).alias("recall"),
    )
    end = points.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("prec"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def threshold_sweep(
    df: DataFrame,
    grid: Sequence[float],
    by: Sequence[str] = (),
    label: str = "label",
    proba: str = "proba",
    zero_degenerate: bool = False,
) -> DataFrame:
    """Cells, precision, recall and F1 of both classes at every threshold of a grid.

    Scores are counted per grid interval first, so the sweep adds up a few
    hundred rows per group however many scores there are.  With
    ``zero_degenerate`` an all-0 or all-1 prediction scores 0.
    """
    keys = list(by) or ["_all"]
    source = df if by else df.withColumn("_all", F.lit(1))
    clean = source.withColumn("_p", plain_zero(F.col(proba))).where(F.col("_p").isNotNull() & ~F.isnan("_p"))
    cut = Bucketizer(splits=[-math.inf, *grid, math.inf], inputCol="_p", outputCol="_cell").transform(clean)
    counts = cut.groupBy(*keys, F.col("_cell").cast("int").alias("k")).agg(
        F.count_if(F.col(label) == 1).alias("_n1"), F.count_if(F.col(label) == 0).alias("_n0")
    )
    steps = F.explode(F.sequence(F.lit(0), F.lit(len(grid)))).alias("k")
    dense = counts.select(*keys).distinct().select(*keys, steps).join(counts, [*keys, "k"], "left")
    upward = W.partitionBy(*keys).orderBy(F.col("k").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*keys)
    n1, n0 = F.coalesce("_n1", F.lit(0)), F.coalesce("_n0", F.lit(0))
    cells = dense.withColumns(
        {
            "tp": F.sum(n1).over(upward), "fp": F.sum(n0).over(upward),
            "_all1": F.sum(n1).over(whole), "_all0": F.sum(n0).over(whole),
        }
    ).where("k > 0")
    cells = cells.withColumns({"fn": F.col("_all1") - F.col("tp"), "tn": F.col("_all0") - F.col("fp")})
    at = F.element_at(F.array(*[F.lit(t) for t in grid]), F.col("k"))
    scores = class_scores()
    degenerate = ((F.col("tp") + F.col("fp")) == 0) | ((F.col("tn") + F.col("fn")) == 0)
    score = lambda c: F.when(degenerate, F.lit(0.0)).otherwise(scores[c]) if zero_degenerate else scores[c]
    out = cells.select(
        *keys, F.col("k"), at.alias("threshold"), "tn", "fp", "fn", "tp",
        score("f1_0").alias("f1_0"), score("f1_1").alias("f1_1"),
        scores["prec_1"].alias("prec_1"), scores["recall_1"].alias("recall_1"),
        scores["prec_0"].alias("prec_0"), scores["recall_0"].alias("recall_0"),
    )
    return out if by else out.drop("_all")


def best_threshold(
    sweep: DataFrame, by: Sequence[str] = (), pos_label: int = 1, fallback: float | None = None
) -> DataFrame:
    """First threshold with the highest F1; ``fallback`` is kept when no F1 exceeds 0."""
    f1 = F.col(f"f1_{pos_label}")
    best = sweep.groupBy(*by).agg(
        F.min(
            F.struct(
                (-f1).alias("neg"), F.col("threshold"), F.col(f"prec_{pos_label}").alias("precision"),
                F.col(f"recall_{pos_label}").alias("recall"),
            )
        ).alias("b")
    )
    value = -F.col("b.neg") + F.lit(0.0)
    at = F.col("b.threshold")
    if fallback is not None:
        at = F.when(value > 0, at).otherwise(F.lit(fallback))
    return best.select(*by, at.alias("threshold"), value.alias("f1"), "b.precision", "b.recall")


def calibration_curve(
    df: DataFrame, by: Sequence[str] = (), bins: int = 10, label: str = "label", proba: str = "proba"
) -> DataFrame:
    """Mean score and positive share per uniform bin; inner edges belong to the lower bin."""
    edges = spaced(0.0, 1.0, bins + 1)[1:-1]
    index = ex.count_edges_below(F.col(proba), edges, inclusive=False) + 1
    return (
        df.where(F.col(proba).isNotNull())
        .groupBy(*by, index.alias("bin"))
        .agg(
            F.count("*").alias("n"),
            F.avg(proba).alias("mean_predicted"),
            F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        )
    )


def overfit_flags(
    metrics: DataFrame, by: Sequence[str], split: str = "period", train: str = "Train", val: str = "Val",
    limit: float = 0.05,
) -> DataFrame:
    """Train minus validation gaps of the 4-digit metrics, and whether they exceed the limit."""
    side = lambda m, s: F.max(F.when(F.col(split) == s, F.round(m, 4)))
    gaps = {
        f"delta_{short}": F.round(side(m, train) - side(m, val), 4)
        for short, m in (("auc", "auc"), ("f1", "f1_macro"), ("mcc", "mcc"))
    }
    out = metrics.groupBy(*by).agg(*[g.alias(n) for n, g in gaps.items()])
    return out.withColumn(
        "overfit", F.coalesce((F.col("delta_auc") > limit) | (F.col("delta_f1") > limit), F.lit(False))
    )


def leaderboard(metrics: DataFrame, name: str, by: Sequence[str] = ("auc", "mcc", "f1_0")) -> DataFrame:
    """Models ranked by the metrics, the first name winning ties (one row per model)."""
    order = [F.col(m).desc_nulls_last() for m in by] + [F.col(name)]
    return metrics.withColumn("rank", F.row_number().over(W.orderBy(*order)))


def best_model(metrics: DataFrame, name: str, metric: str) -> DataFrame:
    return metrics.agg(F.min_by(name, F.struct(-F.col(metric), F.col(name))).alias("best"), F.max(metric).alias(metric))


def compare_runs(base: DataFrame, tuned: DataFrame, name: str, metric: str) -> DataFrame:
    """One metric of the models both runs have, side by side with its change."""
    change = F.col("tuned") - F.col("base")
    return (
        base.select(name, F.col(metric).alias("base"))
        .join(tuned.select(name, F.col(metric).alias("tuned")), name)
        .withColumn("delta", change)
        .orderBy(F.col("tuned").desc(), name)
    )


def risk_order(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", key: str = "id"
) -> DataFrame:
    """Rows numbered from most to least risky (lowest probability of class 1 first).

    Lift and gains follow from this table; pass it as ``ranked`` when several of
    them are wanted.
    """
    slim = df.select(*by, key, label, proba).withColumn(proba, plain_zero(F.col(proba)))
    return positions(
        slim, [F.col(proba), F.col(key)], by=by, sums={"unsatisfied": ex.flag(F.col(label) == 0)}
    )


def lift_by_decile(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", key: str = "id",
    ranked: DataFrame | None = None,
) -> DataFrame:
    """Clients, unsatisfied, their share and lift per tenth of the risk order."""
    ranked = ranked if ranked is not None else risk_order(df, by, label, proba, key)
    index = F.col("pos") - 1
    decile = F.when(F.col("n") > 1, F.greatest(F.lit(1), F.ceil(index * DECILES / (F.col("n") - 1)))).otherwise(1)
    base = F.max("unsatisfied_all") / F.max("n")
    unsatisfied = F.sum(ex.flag(F.col(label) == 0))
    return ranked.groupBy(*by, decile.cast("int").alias("decil")).agg(
        F.count("*").alias("clientes"),
        unsatisfied.alias("insatisfechos"),
        (unsatisfied / F.count("*")).alias("tasa"),
        ex.ratio(unsatisfied / F.count("*"), base).alias("lift"),
    )


def cumulative_lift(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", key: str = "id",
    ranked: DataFrame | None = None,
) -> DataFrame:
    """Lift of the riskiest 10, 20, ... 100 percent; 0 when nobody is unsatisfied."""
    keys = list(by) or ["_all"]
    ranked = ranked if ranked is not None else risk_order(df, by, label, proba, key)
    if not by:
        ranked = ranked.withColumn("_all", F.lit(1))
    # the first tenth whose cut floor(n * i / 10) reaches this position
    tenth = F.expr(f"(pos * {DECILES} + n - 1) div n")
    counts = ranked.groupBy(*keys, tenth.cast("int").alias("i")).agg(
        F.count("*").alias("_n"), F.sum(ex.flag(F.col(label) == 0)).alias("_u")
    )
    steps = F.explode(F.sequence(F.lit(1), F.lit(DECILES))).alias("i")
    dense = counts.select(*keys).distinct().select(*keys, steps).join(counts, [*keys, "i"], "left")
    upto = W.partitionBy(*keys).orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*keys)
    n, u = F.coalesce("_n", F.lit(0)), F.coalesce("_u", F.lit(0))
    sums = dense.withColumns(
        {
            "contacted": F.sum(n).over(upto), "captured": F.sum(u).over(upto),
            "_rate": F.sum(u).over(whole) / F.sum(n).over(whole),
        }
    )
    rate = F.col("captured") / F.nullif(F.col("contacted").cast("double"), F.lit(0.0))
    out = sums.select(
        *keys, (F.col("i") * 10).alias("pct"), "contacted", "captured",
        F.when(F.col("_rate") > 0, rate / F.nullif(F.col("_rate"), F.lit(0.0))).otherwise(F.lit(0.0)).alias("lift"),
    )
    return out if by else out.drop("_all")


def cumulative_gains(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", proba: str = "proba", key: str = "id",
    ranked: DataFrame | None = None,
) -> DataFrame:
    """Share of clients contacted and of unsatisfied clients reached, row by row."""
    ranked = ranked if ranked is not None else risk_order(df, by, label, proba, key)
    return ranked.select(
        *by, key, "pos",
        (F.col("pos") / F.col("n") * 100).alias("pct_population"),
        (F.col("unsatisfied_cum") / F.nullif(F.col("unsatisfied_all"), F.lit(0.0)) * 100).alias("pct_captured"),
    )


def scored_predictions(
    df: DataFrame, threshold: float = 0.5, label: str = "label", proba: str = "proba", key: str = "id"
) -> DataFrame:
    """Rows with real and predicted labels at 0.5 and at a tuned threshold, errors first."""
    text = lambda c: F.when(c == 1, SATISFIED).otherwise(UNSATISFIED)
    p05, pt, y = ex.flag(F.col(proba) >= 0.5), ex.flag(F.col(proba) >= F.lit(threshold)), F.col(label)
    return df.select(
        *[c for c in df.columns if c not in (label, proba)],
        y.alias("y_real"),
        text(y).alias("y_real_etiqueta"),
        F.round(proba, 6).alias("proba_satisfecho"),
        p05.alias("prediccion"),
        text(p05).alias("prediccion_etiqueta"),
        ex.flag(p05 == y).alias("correcto"),
        pt.alias("prediccion_umbral_opt"),
        text(pt).alias("prediccion_umbral_opt_etiqueta"),
        ex.flag(pt == y).alias("correcto_umbral_opt"),
    ).orderBy("correcto", key)


def rates(df: DataFrame, by: Sequence[str], label: str = "label") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("rate"))
