import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderpulse.operators import learners as ln, selection as sel
from orderpulse.plans import stepwise
from orderpulse.plans.dataset import Dataset

# step, trial order, kept features, validation AUC, AUC to beat, expected winner
RUN = [
    (1, 1, 41, 0.7631, 0.7631, True), (1, 2, 41, 0.7631, 0.7631, False),
    (2, 1, 40, 0.7627, 0.7631, True),
    (3, 1, 28, 0.7621, 0.7627, False), (3, 2, 34, 0.7637, 0.7627, False), (3, 3, 36, 0.7634, 0.7627, False),
    (3, 4, 37, 0.7638, 0.7627, True),
    (4, 1, 29, 0.7641, 0.7638, True), (4, 2, 20, 0.7616, 0.7638, False), (4, 3, 11, 0.7546, 0.7638, False),
    (5, 1, 29, 0.7641, 0.7641, True),
    (6, 1, 20, 0.7637, 0.7641, False), (6, 2, 25, 0.7629, 0.7641, False), (6, 3, 29, 0.7641, 0.7641, True),
]
SCHEMA = "paso int, ord int, n_features int, auc_val double, base_auc double, expected boolean"


def test_winners_of_a_known_run(spark):
    out = sel.winners(spark.createDataFrame(RUN, SCHEMA))
    assert out.where("elegido <> expected").count() == 0
    for step in range(1, 7):
        rows = [r for r in RUN if r[0] == step]
        i = sel.pick([r[3] for r in rows], [r[2] for r in rows], rows[0][4])
        assert rows[i][5]


def test_invalid_candidates_never_win(spark):
    rows = [
        (1, 1, 5, 0.70, 0.75, False), (1, 2, 5, None, 0.75, False), (1, 3, 0, 0.80, 0.75, False),
        (2, 1, 5, 0.746, 0.75, True), (2, 2, 5, 0.746, 0.75, False),
    ]
    out = sel.winners(spark.createDataFrame(rows, SCHEMA))
    assert out.where("elegido <> expected").count() == 0
    assert sel.pick([0.70, None, 0.80], [5, 5, 0], 0.75) is None


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    n = 600
    a = rng.normal(0, 1, n)
    y = (a + rng.normal(0, 1, n) > 0).astype(int)
    pdf = pd.DataFrame(
        {
            "order_id": np.arange(n), "split": np.where(np.arange(n) % 3 < 2, "train", "val"), "satisfecho": y,
            "a": a, "a_copy": a * 2 + rng.normal(0, 1e-3, n), "a_third": a + rng.normal(0, 0.05, n),
            "noise": rng.normal(0, 1, n), "flat": 1.0, "small": rng.normal(0, 0.01, n),
        }
    )
    return pdf, spark.createDataFrame(pdf)


FEATURES = ["a", "a_copy", "a_third", "noise", "flat", "small"]


def test_correlation_filter_is_not_iterative(frame):
    """A feature goes when any earlier one correlates, even one that went itself."""
    pdf, df = frame
    r = sel.correlation_values(df, FEATURES)
    assert r[("a", "noise")] == pytest.approx(pdf.a.corr(pdf.noise))
    assert ("a", "flat") not in r
    kept, gone = sel.by_correlation(r, FEATURES, 0.95)
    assert kept == ["a", "noise", "flat", "small"] and gone == ["a_copy", "a_third"]
    only_third = {("a", "b"): 0.99, ("b", "c"): 0.99, ("a", "c"): 0.5}
    assert sel.by_correlation(only_third, ["a", "b", "c"], 0.9)[1] == ["b", "c"]


def test_pairwise_complete_correlation(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(1e6, 1, (200, 3)), columns=list("xyz"))
    pdf.loc[pdf.index % 5 == 0, "y"] = np.nan
    r = sel.correlation_values(spark.createDataFrame(pdf), list("xyz"))
    want = pdf.corr()
    for (a, b), v in r.items():
        assert v == pytest.approx(want.loc[a, b], abs=1e-6)


def test_other_filters(frame):
    _, df = frame
    assert sel.nonconstant(df, FEATURES) == [f for f in FEATURES if f != "flat"]
    assert sel.by_variance(df, FEATURES)[1] == ["flat", "small"]
    gappy = df.withColumn("a", F.when(F.col("order_id") % 10 > 0, F.col("a")))
    assert sel.by_missing(gappy, FEATURES, 0.05)[1] == ["a"] and sel.by_missing(gappy, FEATURES, 0.10)[1] == []
    assert sel.by_psi({"a": 0.2, "b": 0.2001}, ["a", "b"])[1] == ["b"]
    assert sel.by_univariate({"a": 0.51, "b": None, "c": 0.4}, ["a", "b", "c"], 0.01)[0] == ["a", "c"]
    assert sel.by_importance({"a": 0.1, "b": 0.9, "c": 0.5}, ["a", "b", "c"], 2) == (["b", "c"], ["a"])
    assert sel.by_importance({}, ["a", "b"], 2) == (["a", "b"], [])


def test_stepwise_selection_keeps_the_signal(frame):
    _, df = frame
    data = Dataset(df, FEATURES)
    quick = ln.Spec(ln.FOREST, {"n_estimators": 5, "max_depth": 3, "class_weight": "balanced", "seed": 42})
    out = stepwise.select_features(data, judge=quick, univariate=stepwise.rank_aucs)
    assert "a" in out.features and "flat" not in out.features
    steps = out.steps.toPandas()
    assert list(steps.columns[:4]) == ["paso", "metodo", "threshold", "n_features"] and len(steps) == 15
    assert (steps.groupby("paso").elegido.sum() <= 1).all()
    detail = out.detail.toPandas()
    assert {"a_copy", "a_third"} <= set(detail[detail.metodo == "correlation_method"].feature_eliminada)
    assert len(detail) == steps.n_eliminadas.sum()


def test_forest_auc_of_single_features(frame):
    _, df = frame
    found = stepwise.forest_aucs(Dataset(df, FEATURES), ["a", "noise", "flat"], ("train", "val"))
    assert found["a"] > 0.65 and abs(found["noise"] - 0.5) < 0.12 and found["flat"] is None


def test_fits_run_side_by_side_only_while_their_rows_fit(spark, monkeypatch):
    """Candidates of a large table are fitted one after the other, with the same result."""
    from orderpulse.plans import stepwise
    from orderpulse.plans.dataset import Dataset

    rows = [(k, "train" if k % 3 else "val", int(k % 7 > 2), float(k % 7), float(k % 5)) for k in range(300)]
    data = Dataset(spark.createDataFrame(rows, "order_id long, split string, satisfecho int, a double, b double"), ["a", "b"])
    judge = stepwise.ln.Spec(stepwise.ln.FOREST, {"n_estimators": 3, "max_depth": 2, "seed": 1})
    pool, used = stepwise.ThreadPoolExecutor, []
    monkeypatch.setattr(stepwise, "ThreadPoolExecutor", lambda n: used.append(n) or pool(n))
    found = []
    for room in (4_000_000, 100):
        monkeypatch.setattr(stepwise, "TOGETHER_ROWS", room)
        found.append(stepwise._Judge(data, judge, ("train", "val"))([["a"], ["b"], ["a", "b"]]))
    assert used == [4, 1] and found[0] == found[1]


def test_features_are_ranked_once_for_the_candidates(spark):
    from orderpulse.registry import selection

    found = selection._candidates(spark, "/root/testdata/sf0.001")
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
