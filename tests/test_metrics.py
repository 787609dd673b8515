"""Every metric against a direct computation on collected rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderpulse.operators import drift, explain, metrics as mt


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(11)
    n = 1200
    y = rng.integers(0, 2, n)
    p = np.round(np.clip(0.5 + 0.2 * (y - 0.5) + rng.normal(0, 0.2, n), 0, 1), 2)
    p[rng.random(n) < 0.33] = 0.62  # one score holds a third of all rows
    pdf = pd.DataFrame({"id": np.arange(n), "period": rng.choice(["Train", "Val"], n), "label": y, "proba": p})
    return pdf, spark.createDataFrame(pdf).repartition(3)


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    if not len(pos) or not len(neg):
        return None
    gap = pos[:, None] - neg[None, :]
    return ((gap > 0).sum() + 0.5 * (gap == 0).sum()) / (len(pos) * len(neg))


def brute_ap(y, p):
    total, last, area = (y == 1).sum(), 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = (y[hit] == 1).sum() / total
        area += (recall - last) * (y[hit] == 1).mean()
        last = recall
    return area


def brute_scores(y, pred):
    tp, tn = ((y == 1) & (pred == 1)).sum(), ((y == 0) & (pred == 0)).sum()
    fp, fn = ((y == 0) & (pred == 1)).sum(), ((y == 1) & (pred == 0)).sum()
    d = lambda a, b: a / b if b else 0.0
    n = len(y)
    pe = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / n**2
    f1 = lambda a: d(2 * a, 2 * a + fp + fn)
    return {
        "prec_1": d(tp, tp + fp), "recall_1": d(tp, tp + fn), "f1_1": f1(tp), "prec_0": d(tn, tn + fn),
        "recall_0": d(tn, tn + fp), "f1_0": f1(tn), "f1_macro": (f1(tp) + f1(tn)) / 2, "accuracy": (tp + tn) / n,
        "mcc": d(tp * tn - fp * fn, np.sqrt(float(tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))),
        "kappa": d((tp + tn) / n - pe, 1 - pe),
        "bal_acc": (d(tp, tp + fn) + d(tn, tn + fp)) / 2, "gmean": np.sqrt(d(tp, tp + fn) * d(tn, tn + fp)),
    }


def test_all_metrics(scored):
    pdf, df = scored
    got = {r.period: r for r in mt.all_metrics(df, ["period"]).collect()}
    for period, part in pdf.groupby("period"):
        y, p = part.label.to_numpy(), part.proba.to_numpy()
        row = got[period]
        assert row.n == len(part)
        assert row.auc == pytest.approx(brute_auc(y, p)) and row.gini == pytest.approx(2 * row.auc - 1)
        assert row.avg_prec == pytest.approx(brute_ap(y, p))
        assert row.brier == pytest.approx(((p - y) ** 2).mean())
        for name, value in brute_scores(y, (p >= 0.5).astype(int)).items():
            assert row[name] == pytest.approx(value), name


def test_ungrouped_metrics(scored):
    pdf, df = scored
    row = mt.all_metrics(df, []).first()
    assert "_all" not in row.asDict() and row.auc == pytest.approx(brute_auc(pdf.label.to_numpy(), pdf.proba.to_numpy()))


def test_signed_zero_scores_tie(spark):
    df = spark.createDataFrame([(1, 0.0), (0, -0.0), (1, 1.0)], "label int, proba double")
    assert mt.rank_metrics(df).first().auc == 0.75


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.9)], "label int, proba double")
    row = mt.all_metrics(df, []).first()
    assert row.auc is None and row.gini is None and row.avg_prec == 1.0 and row.f1_0 == 0.0


def test_roc_and_pr_points(scored):
    pdf, df = scored
    y, p = pdf.label.to_numpy(), pdf.proba.to_numpy()
    roc = mt.roc_points(df).toPandas()
    assert len(roc) == len(set(p)) + 1
    known = roc.dropna().sort_values("fpr")
    for _, r in known.sample(10, random_state=1).iterrows():
        assert r.tpr == pytest.approx((p[y == 1] >= r.threshold).mean())
        assert r.fpr == pytest.approx((p[y == 0] >= r.threshold).mean())
    ordered = roc.sort_values(["fpr", "tpr"])
    assert np.trapezoid(ordered.tpr, ordered.fpr) == pytest.approx(brute_auc(y, p))
    pr = mt.pr_points(df).toPandas()
    end = pr[pr.threshold.isna()].iloc[0]
    assert (end["prec"], end["recall"]) == (1.0, 0.0)


@pytest.mark.parametrize("grid", [mt.GRID_BASELINE, mt.GRID_BACKTEST, mt.GRID_NOTEBOOK])
def test_threshold_sweep(scored, grid):
    pdf, df = scored
    y, p = pdf.label.to_numpy(), pdf.proba.to_numpy()
    rows = mt.threshold_sweep(df, grid).orderBy("k").collect()
    assert [r.threshold for r in rows] == list(grid)
    for r in rows:
        want = brute_scores(y, (p >= r.threshold).astype(int))
        assert r.f1_1 == pytest.approx(want["f1_1"]) and r.f1_0 == pytest.approx(want["f1_0"])
    best = mt.best_threshold(mt.threshold_sweep(df, grid), pos_label=0).first()
    f1s = [brute_scores(y, (p >= t).astype(int))["f1_0"] for t in grid]
    assert best.threshold == grid[int(np.argmax(f1s))] and best.f1 == pytest.approx(max(f1s))


def test_grids_have_their_published_sizes():
    assert (len(mt.GRID_BASELINE), len(mt.GRID_BACKTEST), len(mt.GRID_NOTEBOOK)) == (200, 181, 40)
    assert np.allclose(mt.GRID_BASELINE, np.linspace(0.01, 0.99, 200), rtol=0, atol=1e-15)
    assert np.allclose(mt.GRID_NOTEBOOK, np.arange(0.1, 0.9, 0.02), rtol=0, atol=1e-15)


def test_degenerate_predictions_and_plateaus(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.5), (0, 0.5)], "label int, proba double")
    rows = mt.threshold_sweep(df, mt.GRID_BASELINE, zero_degenerate=True).collect()
    assert all(r.f1_1 == 0.0 for r in rows)  # every cut predicts all ones or all zeros
    plain = mt.best_threshold(mt.threshold_sweep(df, mt.GRID_BACKTEST), pos_label=1).first()
    assert plain.threshold == mt.GRID_BACKTEST[0]  # first of the plateau
    none = spark.createDataFrame([(1, 0.95)], "label int, proba double")
    best = mt.best_threshold(mt.threshold_sweep(none, mt.GRID_NOTEBOOK), pos_label=0, fallback=0.5).first()
    assert (best.threshold, best.f1) == (0.5, 0.0)


def test_calibration_bins_close_on_the_right(spark):
    df = spark.createDataFrame([(0.0, 0), (0.1, 1), (0.1000001, 0), (0.95, 1), (1.0, 1)], "proba double, label int")
    rows = {r.bin: (r.n, r.fraction_positive) for r in mt.calibration_curve(df).collect()}
    assert rows == {1: (2, 0.5), 2: (1, 0.0), 10: (2, 1.0)}


@pytest.mark.parametrize("n", [10, 11, 37])
def test_deciles_match_quantile_cuts_of_the_position(spark, n):
    df = spark.range(n).selectExpr("id", "id / 100.0D AS proba", "cast(id % 2 AS int) AS label")
    got = mt.lift_by_decile(df).toPandas().set_index("decil").clientes
    want = (pd.qcut(pd.RangeIndex(n), 10, labels=False) + 1)
    assert got.to_dict() == pd.Series(want).value_counts().to_dict()


def test_lift_and_gains(scored):
    pdf, df = scored
    bad = (1 - pdf.sort_values(["proba", "id"]).label).to_numpy()
    n = len(bad)
    rows = {r.pct: r for r in mt.cumulative_lift(df).collect()}
    for i in range(1, 11):
        cut = int(n * i / 10)
        assert rows[i * 10].contacted == cut
        assert rows[i * 10].lift == pytest.approx(bad[:cut].mean() / bad.mean())
    assert rows[100].lift == pytest.approx(1.0)
    gains = mt.cumulative_gains(df).toPandas().sort_values("pos")
    assert np.allclose(gains.pct_captured, np.cumsum(bad) / bad.sum() * 100)
    assert gains.pct_captured.iloc[-1] == pytest.approx(100) and gains.pct_population.iloc[-1] == pytest.approx(100)
    lift = mt.lift_by_decile(df).toPandas()
    assert lift.clientes.sum() == n and lift.insatisfechos.sum() == bad.sum()


def test_lift_without_unsatisfied_is_zero(spark):
    df = spark.range(20).selectExpr("id", "id / 20.0D AS proba", "1 AS label")
    assert {r.lift for r in mt.cumulative_lift(df).collect()} == {0.0}


def test_overfit_uses_rounded_gaps(spark):
    rows = [("a", "Train", 0.80004, 0.6, 0.5), ("a", "Val", 0.75, 0.6, 0.4), ("b", "Train", 0.8002, 0.6, 0.5), ("b", "Val", 0.75, 0.6, 0.5)]
    df = spark.createDataFrame(rows, "model string, period string, auc double, f1_macro double, mcc double")
    got = {r.model: (r.delta_auc, r.delta_mcc, r.overfit) for r in mt.overfit_flags(df, ["model"]).collect()}
    assert got == {"a": (0.05, 0.1, False), "b": (0.0502, 0.0, True)}


def test_leaderboard_and_best(spark):
    df = spark.createDataFrame([("b", 0.7, 0.1, 0.2), ("a", 0.7, 0.1, 0.2), ("c", None, 0.9, 0.9)], "model string, auc double, mcc double, f1_0 double")
    assert [r.model for r in mt.leaderboard(df, "model").orderBy("rank").collect()] == ["a", "b", "c"]
    assert mt.best_model(df.dropna(), "model", "auc").first().best == "a"


def test_scored_predictions_put_errors_first(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.8), (3, 0, 0.1), (4, 1, 0.6)], "id int, label int, proba double")
    rows = mt.scored_predictions(df, threshold=0.7).collect()
    assert [r.id for r in rows] == [2, 1, 3, 4]
    last = rows[-1]
    assert (last.prediccion, last.prediccion_umbral_opt, last.correcto, last.correcto_umbral_opt) == (1, 0, 1, 0)
    assert (last.y_real_etiqueta, last.prediccion_umbral_opt_etiqueta) == ("Satisfecho", "Insatisfecho")


def brute_psi(ref, act, bins, eps, finite):
    edges = np.percentile(ref, np.linspace(0, 100, bins + 1))
    if finite:
        edges = np.unique(edges)
        if len(edges) < 2:
            return 0.0
    else:
        edges[0], edges[-1] = -np.inf, np.inf
    e, a = np.histogram(ref, edges)[0] / len(ref), np.histogram(act, edges)[0] / len(act)
    e, a = np.where(e == 0, eps, e), np.where(a == 0, eps, a)
    return float(np.sum((a - e) * np.log(a / e)))


def test_feature_psi(spark):
    rng = np.random.default_rng(3)
    n = 800
    pdf = pd.DataFrame(
        {
            "side": ["r"] * n + ["a"] * n,
            "shifted": np.concatenate([rng.normal(0, 1, n), rng.normal(0.7, 1.3, n)]),
            "tied": np.concatenate([rng.integers(0, 3, n), rng.integers(0, 5, n)]).astype(float),
            "flat": 1.0,
            "disjoint": np.concatenate([np.arange(n), np.arange(n) + 10.0 * n]),
        }
    )
    pdf["gone"] = np.where(pdf.side == "r", 1.0, np.nan)
    df = spark.createDataFrame(pdf)
    names = ["shifted", "tied", "flat", "disjoint", "gone"]
    got = {r.feature: r.psi for r in drift.feature_psi(df, names, F.col("side") == "r", F.col("side") == "a").collect()}
    ref, act = pdf[pdf.side == "r"], pdf[pdf.side == "a"]
    for f in ("shifted", "tied", "disjoint"):
        assert got[f] == pytest.approx(brute_psi(ref[f], act[f], 10, 1e-6, True), abs=1e-4), f
    assert got["flat"] == 0.0 and got["gone"] == 0.0
    same = drift.feature_psi(df, ["shifted"], F.col("side") == "r", F.col("side") == "r").first()
    assert same.psi == 0.0


def test_score_psi_and_ks(scored):
    pdf, df = scored
    ref, act = (pdf[pdf.period == p].proba.to_numpy() for p in ("Train", "Val"))
    row = drift.score_psi(df, "proba", "period", "Train", ["Val"]).first()
    assert row.psi == pytest.approx(brute_psi(ref, act, 10, 1e-4, False)) and row.band == "estable"
    grid = np.unique(np.concatenate([ref, act]))
    want = max(abs((ref <= v).mean() - (act <= v).mean()) for v in grid)
    assert drift.ks_statistics(df, "proba", "period", "Train", ["Val"]).first().ks == pytest.approx(want)


def test_mann_whitney(scored):
    import math

    pdf, df = scored
    row = drift.mann_whitney(df, "proba", F.col("label") == 1, F.col("label") == 0).first()
    a, b = (pdf[pdf.label == k].proba.to_numpy() for k in (1, 0))
    u = ((a[:, None] > b).sum() + 0.5 * (a[:, None] == b).sum())
    assert row.u == pytest.approx(u)
    assert row.u / (row.n1 * row.n2) == pytest.approx(brute_auc(pdf.label.to_numpy(), pdf.proba.to_numpy()))
    n1, n2, n = len(a), len(b), len(a) + len(b)
    t = pdf.proba.value_counts().to_numpy().astype(float)
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - (t**3 - t).sum() / (n * (n - 1))))
    z = (u - n1 * n2 / 2 + 0.5) / s
    assert row.z == pytest.approx(z) and row.p_less == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)))


def test_linear_attributions_add_up_to_the_logit(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, -1.0), (3, 2.0, 0.5)], "id int, a double, b double")
    w = {"a": 0.4, "b": -1.5}
    phi = explain.linear_attributions(df, w, 0.3)
    for r in phi.collect():
        assert r.base_value + r.phi_a + r.phi_b == pytest.approx(0.3 + 0.4 * r.a - 1.5 * r.b)
    assert [r.feature for r in explain.top_features(phi, list(w), 1).collect()] == ["b"]
    local = explain.explain_row(phi, list(w), "id", 2).collect()
    assert [r.feature for r in local] == ["b", "a"]
    assert explain.linear_score(df, w, 0.3).where("id = 2").first().pred == 1


def test_importance_delta(spark):
    t = lambda rows: spark.createDataFrame(rows, "feature string, importance double")
    out = explain.importance_delta(t([("a", 0.2), ("b", 0.0), ("x", 1.0)]), t([("a", 0.3), ("b", 0.5)]), 15).collect()
    assert [(r.feature, r.delta_pct) for r in out] == [("b", None), ("a", pytest.approx(50.0))]
