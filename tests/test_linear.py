"""Linear models fitted side by side against single fits by brute force."""

import numpy as np
import pytest

from orderpulse.operators import linear as li

N, D = 600, 3


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (N, D)) * [1, 2, 0.5]
    y = (x @ [1.2, -0.5, 2.0] + 0.8 + rng.logistic(0, 1.5, N) > 0).astype(int)
    return x, y, rng.integers(0, 3, N)


@pytest.fixture(scope="module")
def rows(spark, table):
    x, y, fold = table
    data = [(int(a), int(f), [float(v) for v in r]) for a, f, r in zip(y, fold, x)]
    return spark.createDataFrame(data, li.ROWS).repartition(3).cache()


def objective(w, p, x, y):
    a = np.column_stack([x, np.ones(len(x))])
    m = np.where(y == 1, 1, -1) * (a @ w)
    s = np.ones(len(y))
    if p.balanced:
        s = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    short = np.maximum(0, 1 - m)
    loss = {li.LOGISTIC: np.logaddexp(0, -m), li.SQUARED_HINGE: short**2, li.HINGE: short}[p.loss]
    return (w[: D if p.loss == li.LOGISTIC else D + 1] ** 2).sum() / 2 + p.c * (s * loss).sum()


def seen(p, table):
    x, y, fold = table
    keep = fold != p.left_out if p.left_out >= 0 else np.ones(N, bool)
    return x[keep], y[keep]


PROBLEMS = [
    li.Problem(loss, c, balanced, left_out)
    for loss in (li.LOGISTIC, li.SQUARED_HINGE) for c in (0.001, 1.0, 50.0) for balanced in (False, True) for left_out in (-1, 1)
]


@pytest.mark.parametrize("room", [64_000_000, 300])
def test_all_models_are_optimal(rows, table, room, monkeypatch):
    """In one scan per step, and in many blocks of models: nothing near the fitted weights is better."""
    monkeypatch.setattr(li, "SUM_BYTES", room)
    problems = PROBLEMS if room > 1000 else PROBLEMS[::6]
    rng = np.random.default_rng(1)
    for p, m in zip(problems, li.fit_many(rows, problems, D), strict=True):
        assert m.slope < 1e-8
        w, (x, y) = np.append(m.weights, m.intercept), seen(p, table)
        best = objective(w, p, x, y)
        # the gradient, by differences
        for i in range(D + 1):
            e = np.zeros(D + 1)
            e[i] = 1e-5
            assert abs(objective(w + e, p, x, y) - objective(w - e, p, x, y)) / 2e-5 < 1e-3 * max(1, p.c)
        assert all(objective(w + rng.normal(0, s, D + 1), p, x, y) >= best for s in (1e-3, 1e-1, 1) for _ in range(5))


def test_models_together_equal_models_alone(rows):
    together = li.fit_many(rows, PROBLEMS, D)
    for i in (0, 7, 13):
        alone = li.fit_many(rows, [PROBLEMS[i]], D)[0]
        assert np.allclose(alone.weights, together[i].weights, atol=1e-7) and abs(alone.intercept - together[i].intercept) < 1e-7


def test_hinge_is_near_its_optimum(rows, table):
    x, y, _ = table
    p = li.Problem(li.HINGE, 0.5)
    m = li.fit_many(rows, [p], D)[0]
    w = np.append(m.weights, m.intercept)
    best, rng = objective(w, p, x, y), np.random.default_rng(2)
    for s in (1e-3, 1e-2, 1e-1, 1):
        for _ in range(50):
            best = min(best, objective(w + rng.normal(0, s, D + 1), p, x, y))
    assert objective(w, p, x, y) - best <= p.c * N * li.BEND / 2


def test_sigmoids_fit_targets_short_of_0_and_1(rows, table):
    x, y, fold = table
    problems = [li.Problem(li.SQUARED_HINGE, 1.0, False, k) for k in range(3)]
    models = li.fit_many(rows, problems, D)
    for p, m, got in zip(problems, models, li.fit_sigmoids(rows, problems, models), strict=True):
        held = fold == p.left_out
        margin, label = x[held] @ m.weights + m.intercept, y[held]
        n1, n0 = label.sum(), (1 - label).sum()
        target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        a, b = 0.0, 0.0
        for _ in range(100):
            q = 1 / (1 + np.exp(-(a * margin + b)))
            g = [((q - target) * margin).sum(), (q - target).sum()]
            h = q * (1 - q)
            a, b = np.array([a, b]) - np.linalg.solve([[(h * margin**2).sum(), (h * margin).sum()], [(h * margin).sum(), h.sum()]], g)
        assert (got.a, got.b) == pytest.approx((a, b), abs=1e-6)


def slow_rising(weight, height):
    """max over starts of min over ends of block means."""
    n = len(height)
    mean = lambda i, j: np.average(height[i : j + 1], weights=weight[i : j + 1])
    return [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]


def test_rising():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = rng.integers(1, 15)
        w, h = rng.integers(1, 5, n).astype(float), rng.integers(0, 4, n) / 3
        assert np.allclose(li.rising(w, h), slow_rising(w, h))


def test_isotonic_calibrators(rows, table, monkeypatch):
    x, y, fold = table
    problems = [li.Problem(li.SQUARED_HINGE, 1.0, False, k) for k in range(3)]
    models = li.fit_many(rows, problems, D)
    # so many cells that no two margins share one
    got = li.fit_isotonics(rows, problems, models, cells=1 << 20)
    for p, m, c in zip(problems, models, got, strict=True):
        held = fold == p.left_out
        margin, label = x[held] @ m.weights + m.intercept, y[held].astype(float)
        order = np.argsort(margin)
        assert np.allclose(c(margin[order]), li.rising(np.ones(held.sum()), label[order]))
        coarse = li.fit_isotonics(rows, [p], [m], cells=16)[0](np.linspace(-3, 3, 50))
        assert (np.diff(coarse) >= 0).all() and 0 <= coarse.min() and coarse.max() <= 1


def test_confusions_and_calibrated_scores(rows, table):
    x, y, fold = table
    problems = [li.Problem(li.SQUARED_HINGE, c) for c in (0.01, 1.0)]
    scorers = [*li.calibrated(rows, problems, [li.SIGMOID, li.ISOTONIC], 3, D), *li.plain(rows, [li.Problem(c=0.1)], D)]
    assert [len(s.parts) for s in scorers] == [3, 3, 1]
    for s, found in zip(scorers, li.confusions(rows, scorers), strict=True):
        said = s(x) >= 0.5
        assert found.tolist() == [np.sum((y == a) & (said == b)) for a in (0, 1) for b in (False, True)]
        assert (found[0] + found[3]) / N > 0.7


def test_no_rows(spark):
    none = spark.createDataFrame([], li.ROWS)
    assert li.fit_many(none, [li.Problem(), li.Problem(li.SQUARED_HINGE)], 2)[1].weights.tolist() == [0, 0]
    assert li.confusions(none, li.plain(none, [li.Problem()], 2)).tolist() == [[0, 0, 0, 0]]
    assert li.fit_isotonics(none, [li.Problem(left_out=0)], [li.Linear(np.zeros(2), 0.0)])[0](np.zeros(1)).tolist() == [0.5]


def test_hinge_fits_converge_in_few_scans(spark, monkeypatch):
    """Labels that the features hardly tell, so that most rows lie at the hinge's corner."""
    rng = np.random.default_rng(9)
    d, signal = 16, np.array([0.4, -0.2, 0.1, 0.1] * 4)
    x = rng.normal(0, 1, (4000, d)).round(1)
    y = (x @ signal / 2 + rng.logistic(0, 1.5, len(x)) > 0).astype(int)
    data = [(int(a), i % 5, [float(v) for v in r]) for i, (a, r) in enumerate(zip(y, x))]
    rows = spark.createDataFrame(data, li.ROWS).repartition(2).cache()
    scans, add_up = [], li._add_up
    monkeypatch.setattr(li, "_add_up", lambda *args: scans.append(1) or add_up(*args))
    problems = [li.Problem(li.HINGE, c, balanced, k) for c in (0.1, 1.0, 10.0, 100.0) for balanced in (False, True) for k in (0, 1)]
    assert all(m.slope < li.FLAT for m in li.fit_many(rows, problems, d))
    assert len(scans) < 30
