"""Forests from histograms against trees grown row by row."""

import numpy as np
import pandas as pd
import pytest

from orderpulse.operators import forests as fo


@pytest.fixture(scope="module")
def split(spark):
    rng = np.random.default_rng(6)
    n = 1500
    pdf = pd.DataFrame({"order_id": [f"o{i}" for i in range(n)], "good": rng.normal(0, 1, n), "noise": rng.normal(0, 1, n)})
    pdf["flat"], pdf["flag"] = 3.0, rng.integers(0, 2, n).astype(float)
    pdf["u"] = np.abs(pdf.good)
    pdf["y"] = (np.abs(pdf.good) + 0.3 * pdf.flag + rng.normal(0, 0.5, n) > 1).astype(int)
    pdf.loc[::17, "good"] = np.nan
    df = spark.createDataFrame(pdf).repartition(3)
    return pdf, df.where("cast(substr(order_id, 2) AS int) < 1000"), df.where("cast(substr(order_id, 2) AS int) >= 1000")


def slow_tree(bins, labels, weights, depth):
    """Probability per row by trying every cut on the rows themselves."""
    out = np.full(len(bins), np.average(labels, weights=weights))
    if depth == 0 or weights[labels == 1].sum() == 0 or weights[labels == 0].sum() == 0:
        return out

    def gini(mask):
        w = weights[mask].sum()
        p = weights[mask & (labels == 1)].sum() / w
        return w * 2 * p * (1 - p)

    everything = np.ones(len(bins), bool)
    best, cut = 0.0, None
    for c in np.unique(bins)[1:]:
        low = bins < c
        if weights[low].sum() and weights[~low].sum():
            gain = gini(everything) - gini(low) - gini(~low)
            if gain > best + 1e-9:
                best, cut = gain, c
    if cut is None:
        return out
    for side in (bins < cut, bins >= cut):
        out[side] = slow_tree(bins[side], labels[side], weights[side], depth - 1)
    return out


def test_trees_from_counts_are_trees_from_rows():
    rng = np.random.default_rng(2)
    for _ in range(40):
        n = int(rng.integers(5, 60))
        bins, labels = rng.integers(0, 6, n), rng.integers(0, 2, n)
        weights = rng.poisson(1, n).astype(float)
        if not weights.sum():
            continue
        counts = np.zeros((6, 2))
        np.add.at(counts, (bins, labels), weights)
        keep = weights > 0
        want = slow_tree(bins[keep], labels[keep], weights[keep], 3)
        assert np.allclose(fo.grow(counts, 3)[bins[keep]], want)


def test_bootstrap_weights_are_a_sample_with_replacement():
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000)
    w = fo.bootstrap_weights(keys, 30, 42)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.03
    assert (fo.bootstrap_weights(keys[::-1].copy(), 30, 42)[::-1] == w).all() and (fo.bootstrap_weights(keys, 30, 7) != w).any()


def test_aucs_equal_those_of_scored_rows(split):
    """Counts per bin give the AUC that scoring every row gives; partitions and companions do not matter."""
    pdf, train, unseen = split
    names = ["good", "noise", "flat", "flag", "u"]
    got = fo.single_feature_aucs(train, unseen, names, "y", "order_id")
    assert got["flat"] is None and got["good"] > 0.8 and got["u"] > 0.8 and abs(got["noise"] - 0.5) < 0.1
    assert fo.single_feature_aucs(train.repartition(7), unseen.coalesce(1), ["flag", "good"], "y", "order_id") == {k: got[k] for k in ("flag", "good")}
    tp = train.selectExpr("*", "xxhash64(order_id) AS h").toPandas()
    up = unseen.toPandas()
    weights = fo.bootstrap_weights(tp.h.to_numpy(), 30, 42).astype(float)
    y = tp.y.to_numpy()
    weights *= np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))[:, None]
    for f in ("flag", "good"):
        edges = fo.bin_edges(train, [f])[0]
        bins, other = fo._binned(tp[f].to_numpy(), edges), fo._binned(up[f].to_numpy(), edges)
        score = np.zeros(len(edges) + 2)
        for t in range(30):
            counts = np.zeros((len(edges) + 2, 2))
            np.add.at(counts, (bins, y), weights[:, t])
            score += fo.grow(counts, 3)
        s = np.round(score / 30, 12)[other]
        a, b = s[up.y == 1][:, None], s[up.y == 0][None, :]
        assert got[f] == pytest.approx(((a > b) + 0.5 * (a == b)).mean(), abs=1e-9)


def test_odd_tables(split, spark):
    _, train, unseen = split
    assert fo.single_feature_aucs(train, unseen, [], "y", "order_id") == {}
    assert fo.single_feature_aucs(train.limit(0), unseen, ["good"], "y", "order_id") == {"good": None}
    assert fo.single_feature_aucs(train, unseen.limit(0), ["good"], "y", "order_id") == {"good": None}
    assert fo.single_feature_aucs(train, unseen.where("y = 1"), ["good"], "y", "order_id") == {"good": None}


def test_a_value_that_few_rows_hold_varies(spark):
    """All inner quantiles are the lowest value; the rows above it still have a bin of their own."""
    rows = [(k, int(k % 50 == 0 or k % 3 == 0), float(k % 50 == 0), 4.0) for k in range(2000)]
    df = spark.createDataFrame(rows, "order_id long, y int, rare double, constant double")
    assert len(fo.bin_edges(df, ["rare"])[0]) == 2
    found = fo.single_feature_aucs(df, df, ["rare", "constant"], "y", "order_id")
    assert found["constant"] is None and found["rare"] > 0.5
