import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderpulse.operators import drift, learners as ln, quantiles as qn, trees
from orderpulse.plans import stepwise
from orderpulse.plans.dataset import Dataset

FEATURES = ["a", "b", "few", "flat", "noise"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 1200
    pdf = pd.DataFrame({
        "order_id": np.arange(n), "split": np.where(np.arange(n) % 4 < 3, "train", "val"), "a": rng.normal(0, 1, n),
        "b": rng.normal(0, 1, n), "few": rng.integers(0, 5, n).astype(float), "flat": 1.0, "noise": rng.normal(0, 1, n),
    })
    pdf["satisfecho"] = ((pdf.a > 0) ^ (pdf.b > 0.3) ^ (rng.random(n) < 0.1)).astype(int)
    return pdf, spark.createDataFrame(pdf).repartition(3).localCheckpoint()


def grown(codes, y, weight, subset, depth, level=0, node=1):
    """A tree grown row by row: probability of class 1 per row."""
    total = np.array([weight[y == 0].sum(), weight[y == 1].sum()])
    out = np.full(len(y), total[1] / total.sum())
    best, cut = 1e-12 * total.sum(), None
    if level < depth and total.all():
        for f in subset(level, node):
            for c in range(1, trees.BINS + 1):
                left = codes[:, f] < c
                parts = [np.array([weight[m & (y == k)].sum() for k in (0, 1)]) for m in (left, ~left)]
                if all(p.sum() > 0 for p in parts):
                    fall = sum((p**2).sum() / p.sum() for p in parts) - (total**2).sum() / total.sum()
                    if fall > best + 1e-9:
                        best, cut = fall, (left, [p[1] / p.sum() for p in parts])
    if cut is None:
        return out, True
    left, _ = cut
    leaves = []
    for k, m in enumerate((left, ~left)):
        out[m], leaf = grown(codes[m], y[m], weight[m], subset, depth, level + 1, 2 * node + k)
        leaves.append(leaf)
    if all(leaves) and (cut[1][0] > 0.5) == (cut[1][1] > 0.5):
        return np.full(len(y), total[1] / total.sum()), True
    return out, False


@pytest.mark.parametrize("room", [trees.SUM_BYTES, 1])
def test_a_single_tree_equals_one_grown_row_by_row(frame, monkeypatch, room):
    """With all features at every node; counted together or tree after tree."""
    monkeypatch.setattr(trees, "SUM_BYTES", room)
    pdf, df = frame
    binned = ln.Binned.of(df, df, FEATURES, "satisfecho", "order_id", "order_id")
    places = {f: i for i, f in enumerate(FEATURES)}
    forest = trees.fit(binned.table, places, FEATURES, trees=1, depth=4, balanced=True, seed=7)
    rows = binned.table.toPandas().sort_values("order_id")
    codes, y = np.array([list(b) for b in rows.bins], np.uint8), rows.label.to_numpy()
    weight = trees.Draws(rows.h.to_numpy(), 7)(0) * np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    kept = weight > 0
    want, _ = grown(codes[kept], y[kept], weight[kept], lambda *_: range(len(FEATURES)), 4)
    assert np.allclose(forest.probability(codes)[kept], want)
    assert abs(sum(forest.importances().values()) - 1) < 1e-9 and forest.importances()["flat"] == 0


def test_large_tables_get_forests_from_bins(frame, spark, monkeypatch, tmp_path):
    """As good as MLlib's, the same for any partitions, saved and loaded; MLlib's below the limit."""
    pdf, df = frame
    spec = ln.Spec(ln.FOREST, {"n_estimators": 30, "max_depth": 5, "class_weight": "balanced", "seed": 1})
    train, val = df.where("split = 'train'"), df.where("split = 'val'")
    small = ln.fit(spec, train, FEATURES)
    assert isinstance(small, ln.Fitted)
    monkeypatch.setattr(ln, "BINNED_ROWS", 100)
    model = ln.fit(spec, train, FEATURES)
    assert isinstance(model, ln.BinnedForest) and model.rounds() == 30
    auc = lambda m: rank_auc(m.score(val).toPandas())
    assert auc(model) > 0.8 and auc(model) > auc(small) - 0.05
    other = ln.fit(spec, train.repartition(7), FEATURES)
    assert (other.forest.split == model.forest.split).all() and (other.forest.share == model.forest.share).all()
    model.save(str(tmp_path / "m"))
    again = ln.Fitted.load(spark, [str(tmp_path / "m")])
    one, two = (m.score(val).orderBy("order_id").toPandas().proba for m in (model, again))
    assert (one == two).all() and again.importances() == model.importances()


def rank_auc(scored):
    a, b = scored[scored.satisfecho == 1].proba.to_numpy()[:, None], scored[scored.satisfecho == 0].proba.to_numpy()[None, :]
    return ((a > b) + 0.5 * (a == b)).mean()


def test_judge_writes_the_rows_of_a_large_table_once(frame, monkeypatch):
    """All candidates, scores and importances come from one table of bins, whose scores are those of the rows."""
    _, df = frame
    monkeypatch.setattr(ln, "BINNED_ROWS", 100)
    written, real = [], trees.binned_rows
    monkeypatch.setattr(trees, "binned_rows", lambda *a: written.append(1) or real(*a))
    data = Dataset(df, FEATURES)
    judge = stepwise._Judge(data, ln.Spec(ln.FOREST, {"n_estimators": 10, "max_depth": 4, "seed": 1}), ("train", "val"))
    wide, narrow, none = judge([FEATURES, ["b", "a"], ["flat"]])
    assert none == {} and wide["auc_val"] > 0.7 and narrow["auc_val"] > 0.7
    assert judge.importances(["a", "b", "few", "noise"])["a"] > 0.1 and len(written) == 1
    scored = judge.fit(["b", "a"]).score(df.where("split = 'val'")).toPandas()
    assert narrow["auc_val"] == pytest.approx(rank_auc(scored), abs=1e-4)


def test_bins_of_few_and_many_values(spark):
    rows = [(float(k), float(k % 3), None if k % 2 else 5.0, float(k >= 999), 2.0) for k in range(1000)]
    df = spark.createDataFrame(rows, "many double, few double, gaps double, rare double, flat double").repartition(3)
    edges = trees.forest_edges(df, ["many", "few", "gaps", "rare", "flat"])
    assert len(edges["many"]) == trees.BINS - 1 and edges["few"].tolist() == [1.0, 2.0] and edges["rare"].tolist() == [1.0]
    assert not len(edges["gaps"]) and not len(edges["flat"])
    codes = trees.bins_of(np.array([[np.nan, -1.0], [5.0, 0.0], [6.0, 1.5], [7.0, 2.0]]), [edges["gaps"], edges["few"]])
    assert codes.tolist() == [[0, 1], [1, 1], [1, 2], [1, 3]]


def test_quantiles_with_more_ranks_than_cells(spark, monkeypatch):
    """Brackets shrink in every scan even where many ranks lie side by side."""
    monkeypatch.setattr(qn, "READ", 0)
    monkeypatch.setattr(qn, "CELLS", 3)
    probs = [k / 40 for k in range(41)]
    found = qn.exact_quantiles(spark.range(4001).select(F.col("id").cast("double").alias("v")).repartition(4), ["v"], probs)["v"]
    assert found == [100.0 * k for k in range(41)]


def test_counts_of_bins_with_open_and_closed_ends(spark):
    rows = [(1, 0, 0.0), (1, 0, 1.0), (0, 1, 2.0), (1, 1, 3.0), (0, 1, None), (0, 1, float("nan")), (1, 0, -5.0), (0, 0, 9.0)]
    df = spark.createDataFrame(rows, "_r int, _a int, v0 double").repartition(3)
    inf = float("inf")
    told = lambda splits, outer: {
        r["bin"]: (r["ref"], r["act"]) for r in drift._binned_counts(df, ["k"], [splits], outer).collect() if r["key"] == "k"
    }
    assert told([-inf, 0.0, 2.0, float(np.nextafter(3.0, inf)), inf], False) == {-1: (1, 0), 1: (2, 0), 2: (1, 2)}
    assert told([-inf, 1.0, inf], True) == {0: (2, 0), 1: (2, 2)}


def test_baselines_of_a_large_table_grow_their_forest_from_bins(frame, monkeypatch):
    """All four learners are fitted, ranked and measured."""
    from orderpulse.plans import training

    _, df = frame
    monkeypatch.setattr(ln, "BINNED_ROWS", 100)
    quick = {"Random Forest": {"n_estimators": 10}, "Gradient Boosting": {"max_iter": 3}}
    specs = {n: ln.Spec(s.kind, {**s.params, **quick.get(n, {})}) for n, s in training.BASELINES.items()}
    out = training.train_baselines(Dataset(df, FEATURES), specs)
    assert isinstance(out.models["Random Forest"], ln.BinnedForest)
    board = out.leaderboard.collect()
    assert {r["model"] for r in board} == set(training.BASELINES) and board[0]["auc"] > 0.8
