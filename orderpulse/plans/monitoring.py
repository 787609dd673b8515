"""Backtest tables and the report on a new labelled batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from orderpulse.operators import aggregates as ag, drift, explain, learners as ln, metrics as mt
from orderpulse.sources import sinks
from orderpulse.sources.staging import stage


def backtest_tables(
    scored: DataFrame, reference: str, others: Sequence[str], by: str = "period", key: str = "id"
) -> dict[str, DataFrame]:
    """Every table behind a backtest, from (key, period, label, proba) rows."""
    last = scored.where(F.col(by) == others[-1])
    # shared by three tables each: computed once
    totals = stage(mt.score_totals(scored, [by]), "totals")
    ranked = stage(mt.risk_order(last, key=key), "ranked")
    sweep = mt.threshold_sweep(scored, mt.GRID_BACKTEST, [by])
    return {
        "metrics": mt.all_metrics(scored, [by], totals=totals),
        "confusion": mt.confusion_long(mt.confusion(scored, [by]), [by]),
        "roc": mt.roc_points(scored, [by], totals=totals),
        "pr": mt.pr_points(scored, [by], totals=totals),
        "psi": drift.score_psi(scored, "proba", by, reference, others),
        "ks": drift.ks_statistics(scored, "proba", by, reference, others),
        "calibration": mt.calibration_curve(last),
        "thresholds": mt.best_threshold(sweep, [by], pos_label=0),
        "histogram": ag.value_histogram(scored, "proba", 0.0, 1.0, 40, "label"),
        "lift": mt.lift_by_decile(last, key=key, ranked=ranked),
        "cumulative_lift": mt.cumulative_lift(last, key=key, ranked=ranked),
        "gains": mt.cumulative_gains(last, key=key, ranked=ranked),
    }


def batch_report(
    batch: DataFrame, model: ln.Fitted, history: str, label: str = "satisfecho", key: str = "order_id",
    timestamp: str | None = None,
) -> dict[str, DataFrame]:
    """Score a labelled batch, measure it, and append the metrics to the history.

    Attributions are added for linear models: for every row, with the whole
    batch as background.
    """
    rows = batch.select(key, F.col(label).alias("label"), *model.features)
    scored = stage(model.score(rows).select(key, "label", "proba"), "batch")
    totals = stage(mt.score_totals(scored), "totals")
    ranked = stage(mt.risk_order(scored, key=key), "ranked")
    metrics = mt.all_metrics(scored, [], totals=totals)
    trend = sinks.append_history(batch.sparkSession, history, metrics.select("n", "auc", "accuracy", "f1_0"), timestamp)
    out = {
        "scored": mt.scored_predictions(scored, key=key),
        "metrics": metrics,
        "confusion": mt.confusion_long(mt.confusion(scored)),
        "roc": mt.roc_points(scored, totals=totals),
        "pr": mt.pr_points(scored, totals=totals),
        "cumulative_lift": mt.cumulative_lift(scored, key=key, ranked=ranked),
        "gains": mt.cumulative_gains(scored, key=key, ranked=ranked),
        "histogram": ag.value_histogram(scored, "proba", 0.0, 1.0, 30, "label"),
        "trend": sinks.history_trend(trend),
    }
    if len(getattr(model, "pipelines", ())) == 1 and hasattr(model.pipelines[0].stages[-1], "coefficients"):
        weights, intercept = model.linear_weights()
        phi = explain.linear_attributions(rows, weights, intercept, background=rows)
        out["shap"] = phi
        out["shap_importance"] = explain.top_features(phi, model.features, None)
    return out


def compare_importances(base: Mapping[str, float], tuned: Mapping[str, float], spark, top: int = 15) -> DataFrame:
    table = lambda m: spark.createDataFrame(list(m.items()), "feature string, importance double")
    return explain.importance_delta(table(base), table(tuned), top)


def coefficient_table(model: ln.Fitted, spark) -> DataFrame:
    weights, _ = model.linear_weights()
    return spark.createDataFrame(list(weights.items()), "feature string, coef double").orderBy(F.col("coef").desc(), "feature")
