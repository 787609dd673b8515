import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderpulse.operators import learners as ln, metrics as mt
from orderpulse.plans import monitoring, training
from orderpulse.plans.dataset import Dataset
from orderpulse.sources import models as store, sinks
from orderpulse.streaming import batches


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    n = 900
    x = rng.normal(0, 1, (n, 2))
    y = (x @ [1.5, -1.0] + 0.4 + rng.logistic(0, 1, n) > 0).astype(int)
    pdf = pd.DataFrame({"order_id": np.arange(n), "satisfecho": y, "x0": x[:, 0], "x1": x[:, 1]})
    pdf["split"] = np.where(pdf.order_id < 500, "train", np.where(pdf.order_id < 700, "val", "backtest"))
    return Dataset(spark.createDataFrame(pdf).repartition(2), ["x0", "x1"])


def newton(x, y, c, weights=None):
    """Minimise C * sum(loss) + |w|^2 / 2 with a free intercept."""
    a = np.column_stack([x, np.ones(len(x))])
    s = np.ones(len(x)) if weights is None else weights
    w = np.zeros(a.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        g = c * a.T @ (s * (p - y)) + ridge @ w
        h = c * (a * (s * p * (1 - p))[:, None]).T @ a + ridge
        w = w - np.linalg.solve(h, g)
    return w


@pytest.mark.parametrize("c, balanced", [(1.0, None), (0.01, None), (0.1, "balanced")])
def test_logistic_regression_matches_the_summed_loss(data, c, balanced):
    model = ln.fit(ln.Spec(ln.LOGISTIC, {"C": c, "class_weight": balanced, "tol": 1e-12}), data.part("train"), data.features)
    pdf = data.part("train").toPandas()
    y = pdf.satisfecho.to_numpy()
    weights = None
    if balanced:
        weights = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    want = newton(pdf[["x0", "x1"]].to_numpy(), y, c, weights)
    got, intercept = model.linear_weights()
    assert [got["x0"], got["x1"], intercept] == pytest.approx(list(want), abs=1e-4)


@pytest.mark.parametrize(
    "spec",
    [
        ln.Spec(ln.LOGISTIC), ln.Spec(ln.FOREST, {"n_estimators": 10, "max_depth": 4}),
        ln.Spec(ln.BOOSTING, {"max_iter": 5, "max_depth": 2}),
        ln.Spec(ln.SVM, {"max_iter": 20, "calibration_method": "sigmoid", "class_weight": "balanced"}),
        ln.Spec(ln.SVM, {"max_iter": 20, "calibration_method": "isotonic"}),
    ],
    ids=lambda s: f"{s.kind}-{s.params.get('calibration_method', '')}",
)
def test_learners_rank_separable_data_and_survive_saving(spark, tmp_path, data, spec):
    model = ln.fit(spec, data.part("train"), data.features)
    rows = data.part("val").select("order_id", F.col("satisfecho").alias("label"), "x0", "x1")
    scored = model.score(rows)
    assert set(scored.columns) == {"order_id", "label", "x0", "x1", "proba"}
    row = mt.all_metrics(scored, []).first()
    assert row.auc > 0.75 and row.brier < 0.22
    assert scored.where("proba < 0 OR proba > 1 OR proba IS NULL").count() == 0
    model.save(f"{tmp_path}/m")
    again = ln.Fitted.load(spark, [f"{tmp_path}/absent", f"{tmp_path}/m"]).score(rows)
    a, b = (f.orderBy("order_id").toPandas().proba.to_numpy() for f in (scored, again))
    assert np.allclose(a, b)


def test_missing_models_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no fitted model"):
        ln.Fitted.load(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    with pytest.raises(FileNotFoundError, match="no fitted model"):
        store.load_model([f"{tmp_path}/a"])
    with pytest.raises(KeyError, match="available"):
        store.pick_model({"x": "path"}, "y")
    with pytest.raises(ValueError, match="unknown learner"):
        ln.Spec("kernel")


def test_baselines_measure_all_models_at_once(data):
    specs = {"lr": ln.Spec(ln.LOGISTIC), "rf": ln.Spec(ln.FOREST, {"n_estimators": 15, "max_depth": 15})}
    out = training.train_baselines(data, specs)
    assert out.metrics.count() == 4
    flags = {r.model: r.overfit for r in out.overfit.collect()}
    assert flags["rf"] and not flags["lr"]
    assert out.leaderboard.orderBy("rank").first().model == "lr"
    assert out.thresholds.count() == 2


def test_tuning_cross_validation_and_stacking(data):
    spaces = {
        "lr": training.SPACES["Logistic Regression"],
        "rf": lambda rng: ln.Spec(ln.FOREST, {"n_estimators": 5, "max_depth": rng.randint(2, 4)}),
    }
    tuned = training.tune(data, spaces, trials=2, pos_label=0, folds=3, parallelism=2)
    assert {k: len(v) for k, v in tuned.trials.items()} == {"lr": 2, "rf": 2}
    assert tuned.metrics.count() == 4  # two models, two later splits
    cv = {r.model: r for r in tuned.cv.collect()}
    assert cv["lr"].folds == 3 and cv["lr"].cv_f1_mean > 0.5
    stacked = {r.split: r.auc for r in tuned.stacked.collect()}
    assert set(stacked) == {"val", "backtest"} and min(stacked.values()) > 0.75
    history = training.trial_history(data, tuned.trials).toPandas()
    assert (history.sort_values("trial").groupby("model").value.cummax().sort_index() == history.best.sort_index()).all()


def test_search_is_seeded(data):
    draw = lambda seed: [training.SPACES["LinearSVC"](random.Random(seed)).params for _ in range(1)]
    assert draw(1) == draw(1) and draw(1) != draw(2)


def test_out_of_fold_scores_every_row_once(data):
    oof = training.out_of_fold(data, {"lr": ln.Spec(ln.LOGISTIC)}, folds=3)
    assert oof.count() == 500 and oof.select("order_id").distinct().count() == 500


def test_a_repeated_run_leaves_one_row(spark, tmp_path):
    path = f"{tmp_path}/history"
    metrics = lambda n: spark.createDataFrame([(n, 0.7, 0.8, 0.5)], "n long, auc double, accuracy double, f1_0 double")
    for n, stamp in ((1, "2026-01-01 00:00:00"), (2, "2026-02-01 00:00:00"), (3, "2026-01-01 00:00:00")):
        sinks.append_history(spark, path, metrics(n), stamp)
    rows = {r["timestamp"]: r["n_registros"] for r in sinks.read_history(spark, path).collect()}
    assert rows == {"2026-01-01 00:00:00": 3, "2026-02-01 00:00:00": 2}
    assert [r["run"] for r in sinks.history_trend(sinks.read_history(spark, path)).orderBy("run").collect()] == [1, 2]


def test_boosting_stops_early(data):
    spec = {"max_iter": 60, "max_depth": 3, "learning_rate": 0.3}
    whole = ln.fit(ln.Spec(ln.BOOSTING, spec | {"early_stopping": False}), data.part("train"), data.features)
    early = ln.fit(ln.Spec(ln.BOOSTING, spec | {"early_stopping": True}), data.part("train"), data.features)
    assert whole.rounds() == 60 and 1 <= early.rounds() < 60


def test_search_measures_every_draw_once_for_both_classes(data):
    names = ("Logistic Regression", "LinearSVC")
    runs = training.search_rounds(data, {n: training.SPACES[n] for n in names}, trials=12)
    val = data.part("val").toPandas()
    for name in names:
        assert [t.spec for t in runs[0][name]] == [t.spec for t in runs[1][name]] and len(runs[0][name]) == 12
    # single fits by another route give the same cells
    for t0, t1 in list(zip(runs[0]["Logistic Regression"], runs[1]["Logistic Regression"]))[:3]:
        spec = ln.Spec(ln.LOGISTIC, {**t0.spec.params, "tol": 1e-12})
        model = ln.fit(spec, data.part("train"), data.features)
        weights, intercept = model.linear_weights()
        said = (val[["x0", "x1"]].to_numpy() @ [weights["x0"], weights["x1"]] + intercept >= 0).astype(int)
        y = val.satisfecho.to_numpy()
        for c, t in ((0, t0), (1, t1)):
            hit = ((said == c) & (y == c)).sum()
            assert t.value == pytest.approx(2 * hit / ((said == c).sum() + (y == c).sum()), abs=0.02)
    table = training.search_table(data.table.sparkSession, runs).toPandas()
    assert len(table) == 48 and set(table.loss.dropna()) <= {"hinge", "squared_hinge"}
    assert (table.sort_values("trial").groupby(["pos_label", "model"]).f1.cummax().sort_index() == table.best.sort_index()).all()


def test_batch_reports_append_to_the_history(spark, tmp_path, data):
    model = ln.fit(ln.Spec(ln.LOGISTIC), data.part("train"), data.features)
    path = f"{tmp_path}/history"
    first = monitoring.batch_report(data.part("val"), model, path, timestamp="2026-01-01 00:00:00")
    assert first["trend"].count() == 0  # one run is no trend
    second = monitoring.batch_report(data.part("backtest"), model, path, timestamp="2026-01-02 00:00:00")
    rows = second["trend"].orderBy("run").collect()
    assert [(r.run, r.n_registros) for r in rows] == [(1, 200), (2, 200)]
    assert rows[1].auc_roc == pytest.approx(second["metrics"].first().auc)
    assert second["scored"].count() == 200 and second["shap"].count() == 200
    top = second["shap_importance"].collect()
    assert [r.feature for r in top] == ["x0", "x1"]
    assert second["gains"].agg(F.max("pct_captured")).first()[0] == pytest.approx(100)


def test_backtest_tables(data):
    model = ln.fit(ln.Spec(ln.LOGISTIC), data.part("train"), data.features)
    scored = model.score(data.table.select(F.col("order_id").alias("id"), F.col("split").alias("period"), F.col("satisfecho").alias("label"), "x0", "x1"))
    tables = monitoring.backtest_tables(scored.drop("x0", "x1"), "train", ["val", "backtest"])
    for name, table in tables.items():
        assert table.count() > 0, name
    assert tables["psi"].count() == 2 and tables["metrics"].count() == 3


def test_importances_side_by_side(spark, data):
    lr = ln.fit(ln.Spec(ln.LOGISTIC), data.part("train"), data.features)
    rf = ln.fit(ln.Spec(ln.FOREST, {"n_estimators": 5, "max_depth": 3}), data.part("train"), data.features)
    assert monitoring.compare_importances(rf.importances(), lr.importances(), spark).count() == 2
    coefs = monitoring.coefficient_table(lr, spark).collect()
    assert [r.feature for r in coefs] == ["x0", "x1"]


def test_streamed_batches_score_each_file_once(spark, tmp_path, data):
    model = ln.fit(ln.Spec(ln.LOGISTIC), data.part("train"), data.features)
    source, output, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check"
    run = lambda: batches.score_new_batches(
        spark, source, data.table.schema, model, output, checkpoint, files_per_batch=1
    ).awaitTermination()
    data.part("val").coalesce(1).write.mode("append").parquet(source)
    run()
    assert [r.n for r in batches.batch_history(spark, output).collect()] == [200]
    data.part("backtest").coalesce(1).write.mode("append").parquet(source)
    run()
    run()  # nothing new
    assert [r.n for r in batches.batch_history(spark, output).collect()] == [200, 200]
    assert spark.read.parquet(f"{output}/scores").select("order_id").distinct().count() == 400


def test_added_scores_go_to_a_new_table(spark, tmp_path, data):
    labels = data.part("val").select("order_id", "satisfecho")
    scores = labels.select("order_id", F.lit(0.123456789).alias("proba")).where("order_id <> 500")
    out = sinks.add_scores(labels, scores, f"{tmp_path}/scored")
    assert out.count() == 200
    assert out.where("proba_satisfecho = 0.123457").count() == 199
