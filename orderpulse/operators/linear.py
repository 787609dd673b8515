"""Many linear classifiers fitted at once: one scan of the rows per Newton step serves all of them.

Candidates of a search, folds of a calibration and folds of a cross-validation differ in a penalty, a loss, class weights
and left-out rows only.  Their weights are the columns of one matrix; a task computes all margins with one product and all
curvatures with another (products of two features times row weights), and sends one vector of sums per model.  The driver
solves the small systems and leaves out models that have converged.  Steps that did not improve are shortened together: one
more scan adds up their losses at all ``SCALES`` of the step, and the best is taken.  Of models that differ in C only, the one
in the middle is fitted first and the others start from its weights; every model ends where its own gradient on all of its rows
vanishes.

Every model minimises ``|w|^2 / 2 + C sum(weight * loss)``.  The intercept of logistic regression is free, that of the
SVM is part of w.  Losses of the signed margin m: logistic ``log(1 + exp(-m))``; squared hinge ``max(0, 1 - m)^2``; hinge
``max(0, 1 - m)``, rounded to a parabola over the last ``BEND`` before its corner, which moves a row's loss by BEND / 2 at
most and gives Newton's method a curvature.

Sigmoid calibrators are fitted the same way, two numbers per model, on targets ``(n1 + 1) / (n1 + 2)`` and ``1 / (n0 + 2)``.
Isotonic ones pool margins in ``CELLS`` even cells between a model's extremes, which bounds what is sent, and then merge
neighbours that fall.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderpulse.operators.arrays import SLOTS, add_slots, slot_rows

LOGISTIC, SQUARED_HINGE, HINGE = "logistic", "squared_hinge", "hinge"
SIGMOID, ISOTONIC = "sigmoid", "isotonic"
BEND = 0.05
CELLS = 4_096
#: Largest entry of the mean loss's gradient at which a model counts as converged, and the scans it may take.
FLAT, STEPS = 1e-9, 60
#: Parts of a step that are tried when the whole of it is too long.
SCALES = 0.5 ** np.arange(1, 21)
#: Bytes of sums that one scan may hold in a task, and of one block of rows.
SUM_BYTES, ROW_BYTES = 64_000_000, 16_000_000

#: Columns of the rows that fits read: label 0/1, fold (or -1) and the features as an array.
ROWS = "label int, fold int, x array<double>"


@dataclass(frozen=True)
class Problem:
    """One model to fit.  Rows of the folds ``left_out`` (on which it is calibrated) and ``outer`` are not seen; -1 is none."""

    loss: str = LOGISTIC
    c: float = 1.0
    balanced: bool = False
    left_out: int = -1
    outer: int = -1


@dataclass
class Linear:
    weights: np.ndarray
    intercept: float
    slope: float = 0.0  # largest entry of the mean loss's gradient
    steps: int = 0


@dataclass
class Calibrator:
    """A probability from a margin: ``1 / (1 + exp(-(a m + b)))``, or a rising line through knots."""

    kind: str
    a: float = 1.0
    b: float = 0.0
    knots: list[float] = field(default_factory=list)
    heights: list[float] = field(default_factory=list)

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        if self.kind == SIGMOID:
            return 0.5 * (1 + np.tanh((self.a * margin + self.b) / 2))
        if not self.knots:
            return np.full(margin.shape, 0.5)
        return np.interp(margin, self.knots, self.heights)


def feature_rows(df: DataFrame, features: Sequence[str], label: str, fold: str | None = None, *keep: str) -> DataFrame:
    """Rows as the fits read them, and the columns to keep."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    return df.select(
        F.col(label).cast("int").alias("label"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"), x.alias("x"), *keep
    )


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Labels, folds and features of a block of rows; ``width`` numbers a row are worked out from it."""
    size = max(64, ROW_BYTES // (8 * max(1, width)))
    for batch in batches:
        for i in range(0, len(batch), size):
            part = batch.slice(i, size)
            x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), x


def _add_up(rows: DataFrame, sums: Callable[[Iterator[tuple]], np.ndarray | None], width: int) -> np.ndarray:
    """One scan: every task's matrix of sums (a row per model), added up by model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sums(_blocks(batches, width))
        if own is not None:
            yield slot_rows(own)

    found = add_slots(rows.select("label", "fold", "x").mapInArrow(run, SLOTS))
    return np.array([found[k] for k in sorted(found)])


def _derivatives(loss: str, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A loss, its slope and its curvature at signed margins."""
    if loss == LOGISTIC:
        p = 0.5 * (1 - np.tanh(m / 2))  # of being wrong
        return np.logaddexp(0, -m), -p, p * (1 - p)
    short = 1 - m
    if loss == SQUARED_HINGE:
        short = np.maximum(short, 0)
        return short**2, -2 * short, 2.0 * (short > 0)
    near = (short > 0) & (short < BEND)
    value = np.where(near, short**2 / (2 * BEND), np.maximum(short - BEND / 2, 0))
    return value, np.where(near, -short / BEND, -1.0 * (short >= BEND)), near / BEND


def _seen(problems: Sequence[Problem], folds: np.ndarray) -> np.ndarray:
    seen = np.ones((len(folds), len(problems)), bool)
    for out in (np.array([p.left_out for p in problems]), np.array([p.outer for p in problems])):
        seen &= (folds[:, None] != out[None, :]) | (out < 0)[None, :]
    return seen


def fold_counts(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Rows of class 0 and of class 1 per fold."""
    found: dict[int, list[int]] = {}
    for r in rows.groupBy("fold", "label").count().collect():
        found.setdefault(r["fold"], [0, 0])[r["label"]] += r["count"]
    return {k: (v[0], v[1]) for k, v in found.items()}


def _class_weights(problems: Sequence[Problem], counts: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Weight of class 0 and 1 per model, and the total weight of its rows."""
    weights, totals = [], []
    for p in problems:
        n0, n1 = (sum(c[i] for f, c in counts.items() if f < 0 or f not in (p.left_out, p.outer)) for i in (0, 1))
        pair = ((n0 + n1) / (2 * n0) if n0 else 1.0, (n0 + n1) / (2 * n1) if n1 else 1.0) if p.balanced else (1.0, 1.0)
        weights.append(pair)
        totals.append(max(1.0, n0 * pair[0] + n1 * pair[1]))
    return np.array(weights), np.array(totals)


def fit_many(rows: DataFrame, problems: Sequence[Problem], d: int) -> list[Linear]:
    """Fit every problem on rows of ``d`` features; the rows are read once per step, so stage them."""
    problems = list(problems)
    pairs = np.triu_indices(d + 1)
    block = max(1, SUM_BYTES // (8 * (len(pairs[0]) + d + 2)))
    counts = fold_counts(rows)
    pilots = _pilots(problems)
    found: dict[int, Linear] = {}
    for turn in (sorted(set(pilots.values())), [i for i, pilot in pilots.items() if i != pilot]):
        for i in range(0, len(turn), block):
            mine = turn[i : i + block]
            start = [found.get(pilots[k]) for k in mine]
            found |= zip(mine, _fit_block(rows, [problems[k] for k in mine], d, counts, start))
    return [found[i] for i in range(len(problems))]


def _pilots(problems: Sequence[Problem]) -> dict[int, int]:
    """For every problem, the one with the middle C among those that differ from it in C only."""
    groups: dict[Problem, list[int]] = {}
    for i, p in enumerate(problems):
        groups.setdefault(replace(p, c=1.0), []).append(i)
    out = {}
    for mine in groups.values():
        middle = sorted(mine, key=lambda i: problems[i].c)[len(mine) // 2]
        out |= {i: middle for i in mine}
    return out


def _fit_block(
    rows: DataFrame, problems: list[Problem], d: int, counts: dict[int, tuple[int, int]], start: Sequence[Linear | None] = ()
) -> list[Linear]:
    weights, totals = _class_weights(problems, counts)
    c = np.array([p.c for p in problems])
    free = np.array([p.loss == LOGISTIC for p in problems])
    ridge = np.ones((len(problems), d + 1))
    ridge[free, d] = 0.0
    # the first step leads from zero, whose loss is known, to the weights to start from
    base = np.zeros((len(problems), d + 1))
    step = np.array([np.append(m.weights, m.intercept) if m else np.zeros(d + 1) for m in start or [None] * len(problems)])
    w = base + step
    nothing = c * totals * [_derivatives(p.loss, np.zeros(1))[0][0] for p in problems]
    best = np.where(step.any(1), nothing, np.inf)
    searched = np.zeros(len(problems), bool)
    slope, taken = np.full(len(problems), np.inf), np.zeros(len(problems), int)
    active = np.arange(len(problems))
    for _ in range(STEPS):
        if not len(active):
            break
        # models that differ in C only start from the same weights, where their sums are the same
        same: dict[tuple, int] = {}
        at = [same.setdefault((replace(problems[i], c=1.0), w[i].tobytes()), len(same)) for i in active]
        told = active[[at.index(k) for k in range(len(same))]]
        value, gradient, curvature = (x[at] for x in _sums(rows, [problems[i] for i in told], w[told], weights[told]))
        value = c[active] * value + (ridge[active] * w[active] ** 2).sum(1) / 2
        gradient = c[active, None] * gradient + ridge[active] * w[active]
        curvature = c[active, None, None] * curvature
        taken[active] += 1
        # rounding may hide the last improvement
        worse = value > best[active] + 1e-12 * np.abs(best[active])
        still, long, given_up = [], [], []
        for k, i in enumerate(active):
            if worse[k]:
                # a part of the step that has been searched for is no better either: rounding hides the rest
                (given_up if searched[i] else long).append(i)
                continue
            slope[i] = np.abs(gradient[k]).max() / (c[i] * totals[i])
            if slope[i] < FLAT:
                continue
            best[i], base[i], searched[i] = value[k], w[i], False
            hessian = curvature[k] + np.diag(ridge[i])
            hessian[np.diag_indices(d + 1)] += 1e-10 * max(1, hessian.trace() / (d + 1))
            step[i] = -np.linalg.solve(hessian, gradient[k])
            w[i] = base[i] + step[i]
            still.append(i)
        if long:
            parts = base[long][:, None, :] + SCALES[None, :, None] * step[long][:, None, :]
            tried = _losses(rows, [problems[i] for i in long], base[long], step[long], weights[long])
            tried = c[long][:, None] * tried + (ridge[long][:, None, :] * parts**2).sum(2) / 2
            for k, i in enumerate(long):
                at = int(np.argmin(tried[k]))
                if tried[k, at] < best[i]:
                    w[i], searched[i] = parts[k, at], True
                    still.append(i)
                else:
                    given_up.append(i)
        for i in given_up:
            w[i] = base[i]
            if np.isinf(slope[i]):
                # the weights to start from were no better than zero
                best[i], searched[i] = np.inf, False
                still.append(i)
        active = np.array(sorted(still), int)
    return [Linear(w[i, :d].copy(), float(w[i, d]), float(slope[i]), int(taken[i])) for i in range(len(problems))]


def _row_weights(problems: Sequence[Problem], weights: np.ndarray, label: np.ndarray, folds: np.ndarray) -> np.ndarray:
    """Weight of every row (columns) in every model (rows); 0 of rows that a model does not see."""
    names, at = np.unique(folds, return_inverse=True)
    seen = _seen(problems, names).T
    table = np.concatenate([weights[:, :1] * seen, weights[:, 1:] * seen], axis=1)
    return table[:, label * len(names) + at]


def _sums(rows: DataFrame, problems: list[Problem], w: np.ndarray, weights: np.ndarray):
    """Loss, gradient and curvature of every model at its weights, without C and the penalty."""
    d1 = w.shape[1]
    first, second = np.triu_indices(d1)
    ends = np.cumsum([0, *range(d1, 0, -1)])
    kinds = {k: np.array([p.loss == k for p in problems]) for k in {p.loss for p in problems}}

    def sums(blocks: Iterator[tuple]) -> np.ndarray | None:
        out = None
        for label, folds, x in blocks:
            # a row of the block per column: what is worked out for a model or a product of features lies together
            a = np.ones((d1, len(x)))
            a[:-1] = x.T
            sign = np.where(label == 1, 1.0, -1.0)
            weight = _row_weights(problems, weights, label, folds)
            margin = (w @ a) * sign
            value, slope, bend = (np.empty_like(margin) for _ in range(3))
            for kind, mine in kinds.items():
                value[mine], slope[mine], bend[mine] = _derivatives(kind, margin[mine])
            pairs = np.empty((len(first), len(x)))
            for i in range(d1):
                np.multiply(a[i:], a[i], out=pairs[ends[i] : ends[i + 1]])
            part = np.column_stack([(weight * value).sum(1), (weight * slope * sign) @ a.T, (weight * bend) @ pairs.T])
            out = part if out is None else out + part
        return out

    found = _add_up(rows, sums, max(len(first), 3 * len(problems)))
    if not len(found):
        found = np.zeros((len(problems), 1 + d1 + len(first)))
    curvature = np.zeros((len(problems), d1, d1))
    curvature[:, first, second] = curvature[:, second, first] = found[:, 1 + d1 :]
    return found[:, 0], found[:, 1 : 1 + d1], curvature


def _losses(rows: DataFrame, problems: list[Problem], base: np.ndarray, step: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss of every model at all ``SCALES`` of its step, without C and the penalty."""
    kinds = {k: np.array([p.loss == k for p in problems]) for k in {p.loss for p in problems}}

    def sums(blocks: Iterator[tuple]) -> np.ndarray | None:
        out = None
        for label, folds, x in blocks:
            sign = np.where(label == 1, 1.0, -1.0)
            weight = _row_weights(problems, weights, label, folds)
            here, change = ((v[:, :-1] @ x.T + v[:, -1:]) * sign for v in (base, step))
            part = np.empty((len(problems), len(SCALES)))
            for kind, mine in kinds.items():
                for k, scale in enumerate(SCALES):
                    part[mine, k] = (weight[mine] * _derivatives(kind, here[mine] + scale * change[mine])[0]).sum(1)
            out = part if out is None else out + part
        return out

    found = _add_up(rows, sums, 6 * len(problems))
    return found if len(found) else np.zeros((len(problems), len(SCALES)))


def _margins(models: Sequence[Linear], x: np.ndarray) -> np.ndarray:
    return x @ np.array([m.weights for m in models]).T + np.array([m.intercept for m in models])


def fit_sigmoids(rows: DataFrame, problems: Sequence[Problem], models: Sequence[Linear]) -> list[Calibrator]:
    """Logistic curves through the margins of the rows that each model did not see, on targets short of 0 and 1."""
    problems, models = list(problems), list(models)
    counts = fold_counts(rows)
    n0, n1 = (np.array([counts.get(p.left_out, (0, 0))[i] for p in problems], float) for i in (0, 1))
    high, low = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
    held = np.array([p.left_out for p in problems])
    ab = np.column_stack([np.zeros(len(problems)), np.log((n1 + 1) / (n0 + 1))])
    base, step = ab.copy(), np.zeros_like(ab)
    best, scale = np.full(len(problems), np.inf), np.ones(len(problems))
    active = np.arange(len(problems))
    for _ in range(STEPS):
        if not len(active):
            break
        now, mine = ab[active], [models[i] for i in active]

        def sums(blocks: Iterator[tuple], now=now, mine=mine, at=active) -> np.ndarray | None:
            out = None
            for label, folds, x in blocks:
                m = _margins(mine, x)
                weight = (folds[:, None] == held[at][None, :]).astype(float)
                target = np.where(label[:, None] == 1, high[at], low[at])
                z = m * now[:, 0] + now[:, 1]
                p = 0.5 * (1 + np.tanh(z / 2))
                value = weight * (np.logaddexp(0, z) - target * z)
                g, h = weight * (p - target), weight * p * (1 - p)
                part = np.column_stack([s.sum(0) for s in (value, g * m, g, h * m * m, h * m, h)])
                out = part if out is None else out + part
            return out

        found = _add_up(rows, sums, 4 * len(active))
        if not len(found):
            break
        still = []
        for k, i in enumerate(active):
            value, ga, gb, haa, hab, hbb = found[k]
            if value > best[i] + 1e-12 * abs(best[i]):
                if scale[i] > 1e-6:
                    scale[i] /= 2
                    ab[i] = base[i] + scale[i] * step[i]
                    still.append(i)
                continue
            size = max(1.0, n0[i] + n1[i])
            if max(abs(ga), abs(gb)) / size < FLAT:
                continue
            best[i], base[i], scale[i] = value, ab[i], 1.0
            ridge = 1e-12 * max(1.0, haa + hbb)
            step[i] = -np.linalg.solve([[haa + ridge, hab], [hab, hbb + ridge]], [ga, gb])
            ab[i] = base[i] + step[i]
            still.append(i)
        active = np.array(still, int)
    return [Calibrator(SIGMOID, float(a), float(b)) for a, b in ab]


def rising(weight: np.ndarray, height: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence nearest to ``height`` in weighted squares: neighbours that fall are merged."""
    sums: list[list[float]] = []  # weight, weighted height, cells
    for w, h in zip(weight.tolist(), height.tolist()):
        sums.append([w, w * h, 1])
        while len(sums) > 1 and sums[-2][1] * sums[-1][0] >= sums[-1][1] * sums[-2][0]:
            w2, s2, n2 = sums.pop()
            sums[-1] = [sums[-1][0] + w2, sums[-1][1] + s2, sums[-1][2] + n2]
    return np.concatenate([np.full(int(n), s / w) for w, s, n in sums]) if sums else np.empty(0)


def fit_isotonics(rows: DataFrame, problems: Sequence[Problem], models: Sequence[Linear], cells: int = CELLS) -> list[Calibrator]:
    """Rising curves through the margins of the rows that each model did not see."""
    problems, models = list(problems), list(models)
    held = np.array([p.left_out for p in problems])
    block = max(1, SUM_BYTES // (24 * cells))
    if len(problems) > block:
        return [
            m for i in range(0, len(problems), block)
            for m in fit_isotonics(rows, problems[i : i + block], models[i : i + block], cells)
        ]

    extremes = rows.select("label", "fold", "x").mapInArrow(_extremes(models, held), "model int, lo double, hi double")
    found = {r["model"]: (r["lo"], r["hi"]) for r in extremes.groupBy("model").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()}
    low = np.array([found[i][0] if i in found else 0.0 for i in range(len(models))])
    width = np.array([found[i][1] - found[i][0] if i in found else 0.0 for i in range(len(models))])
    width = np.where(width > 0, width, 1.0)

    def sums(blocks: Iterator[tuple]) -> np.ndarray | None:
        out = None
        for label, folds, x in blocks:
            m = _margins(models, x)
            out = np.zeros((len(models), 3 * cells)) if out is None else out
            for i in range(len(models)):
                mine = folds == held[i]
                cell = np.clip(((m[mine, i] - low[i]) / width[i] * cells).astype(int), 0, cells - 1)
                out[i, :cells] += np.bincount(cell, minlength=cells)
                out[i, cells : 2 * cells] += np.bincount(cell, label[mine], cells)
                out[i, 2 * cells :] += np.bincount(cell, m[mine, i], cells)
        return out

    out = []
    for row in _add_up(rows, sums, 2 * len(models)):
        n, ones, total = row[:cells], row[cells : 2 * cells], row[2 * cells :]
        full = np.flatnonzero(n)
        heights = rising(n[full], ones[full] / n[full])
        out.append(Calibrator(ISOTONIC, knots=(total[full] / n[full]).tolist(), heights=heights.tolist()))
    return out or [Calibrator(ISOTONIC) for _ in models]


def _extremes(models: Sequence[Linear], held: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi = np.full(len(models), np.inf), np.full(len(models), -np.inf)
        for _, folds, x in _blocks(batches, 2 * len(models)):
            m, mine = _margins(models, x), folds[:, None] == held[None, :]
            lo = np.minimum(lo, np.where(mine, m, np.inf).min(0))
            hi = np.maximum(hi, np.where(mine, m, -np.inf).max(0))
        seen = np.flatnonzero(lo <= hi)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(lo[seen]), pa.array(hi[seen])], ["model", "lo", "hi"]
        )

    return run


@dataclass
class Scorer:
    """A probability: the mean of calibrated margins, or the sigmoid of a single margin."""

    parts: list[tuple[Linear, Calibrator]]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        margins = _margins([m for m, _ in self.parts], x)
        return np.mean([c(margins[:, i]) for i, (_, c) in enumerate(self.parts)], axis=0)


def confusions(rows: DataFrame, scorers: Sequence[Scorer], cut: float = 0.5) -> np.ndarray:
    """``tn, fp, fn, tp`` of every scorer from one scan."""
    scorers = list(scorers)

    def sums(blocks: Iterator[tuple]) -> np.ndarray | None:
        out = None
        for label, _, x in blocks:
            out = np.zeros((len(scorers), 4)) if out is None else out
            for i, scorer in enumerate(scorers):
                out[i] += np.bincount(2 * label + (scorer(x) >= cut), minlength=4)
        return out

    found = _add_up(rows, sums, 2 * sum(len(s.parts) for s in scorers))
    return found if len(found) else np.zeros((len(scorers), 4))


def fold_scores(rows: DataFrame, scorers: Mapping[str, Mapping[int, Scorer]], key: str) -> DataFrame:
    """Rows of each fold scored by that fold's scorer, per model, from one scan of rows that keep their key."""
    source = rows.select(key, "fold", "label", "x")
    names = list(scorers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            folds = batch.column(1).to_numpy()
            for name in names:
                proba = np.full(len(batch), np.nan)
                for k in np.unique(folds).tolist():
                    mine = folds == k
                    proba[mine] = scorers[name][k](x[mine])
                told = [pa.array([name] * len(batch)), *batch.columns[:3], pa.array(proba)]
                yield pa.RecordBatch.from_arrays(told, ["model", key, "fold", "label", "proba"])

    return source.mapInArrow(run, f"model string, `{key}` {dict(rows.dtypes)[key]}, fold int, label int, proba double")


def calibrated(rows: DataFrame, problems: Sequence[Problem], methods: Sequence[str], folds: int, d: int) -> list[Scorer]:
    """For every problem one model per fold, each calibrated on the fold that it did not see; a problem's outer fold has none."""
    jobs = [replace(p, left_out=k) for p in problems for k in range(folds) if k != p.outer]
    models = fit_many(rows, jobs, d)
    each = [folds - (0 <= p.outer < folds) for p in problems]
    kinds = [method for method, n in zip(methods, each) for _ in range(n)]
    calibrators: list[Calibrator | None] = [None] * len(jobs)
    for kind, fit in ((SIGMOID, fit_sigmoids), (ISOTONIC, fit_isotonics)):
        mine = [i for i, k in enumerate(kinds) if k == kind]
        if mine:
            for i, c in zip(mine, fit(rows, [jobs[i] for i in mine], [models[i] for i in mine])):
                calibrators[i] = c
    parts, ends = list(zip(models, calibrators)), np.cumsum([0, *each])
    return [Scorer(parts[a:z]) for a, z in zip(ends, ends[1:])]


def plain(rows: DataFrame, problems: Sequence[Problem], d: int) -> list[Scorer]:
    """Logistic models, whose probability is the sigmoid of their margin."""
    return [Scorer([(m, Calibrator(SIGMOID))]) for m in fit_many(rows, problems, d)]
