"""Stepwise champion/challenger feature selection."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, functions as F

from orderpulse.operators import forests, learners as ln, metrics as mt, quality as qa, selection as sel, trees
from orderpulse.plans.dataset import Dataset
from orderpulse.sources.staging import stage

# The forests that judge candidates and single features.
JUDGE = ln.Spec(ln.FOREST, {"n_estimators": 100, "max_depth": 6, "class_weight": "balanced", "seed": 42})
SINGLE = ln.Spec(ln.FOREST, {"n_estimators": 30, "max_depth": 3, "class_weight": "balanced", "seed": 42})

# Step names and columns of the selection table.
START = "Estado_Inicial"
STEPS = (
    "missing_variable_method", "PSI_method", "correlation_method", "univariante_method", "variance_threshold_method",
    "rf_importance_method [EXTRA]",
)
METRICS = (("auc", "auc"), ("acc", "accuracy"), ("rec", "recall_1"), ("prec", "prec_1"), ("f1", "f1_1"), ("gini", "gini"))
PARALLELISM = 4  # fits running side by side
#: Rows that fits side by side may hold together: MLlib's forests keep each row with a count per tree in memory.
TOGETHER_ROWS = 4_000_000
TABLE_SCHEMA = (
    "paso int, metodo string, threshold string, n_features int, "
    + ", ".join(f"{m}_{side} double" for m, _ in METRICS for side in ("train", "val"))
    + ", n_eliminadas int, features_eliminadas array<string>, elegido boolean"
)


@dataclass
class Selection:
    features: list[str]
    steps: DataFrame
    detail: DataFrame


def side_by_side(rows: int, parallelism: int = PARALLELISM) -> int:
    """Fits that run at once: fewer the more rows there are, as a single one keeps all cores busy then."""
    return max(1, min(parallelism, TOGETHER_ROWS // max(1, rows)))


class _Judge:
    """Trains the judging forest once per feature set and remembers its metrics.

    The candidates of one step are fitted side by side and measured together.  On a large table all forests read the same
    binned rows, which are written once.
    """

    def __init__(self, data: Dataset, spec: ln.Spec, split: tuple[str, str], parallelism: int = PARALLELISM):
        self.data, self.spec, self.split, self.parallelism = data, spec, split, parallelism
        self.seen: dict[tuple[str, ...], dict[str, float | None]] = {}
        self.models: dict[tuple[str, ...], ln.Fitted | ln.CalibratedLinear | ln.BinnedForest] = {}

    def rows(self) -> tuple[DataFrame, DataFrame]:
        return self.data.part(self.split[0]), self.data.part(*self.split)

    @functools.cached_property
    def size(self) -> int:
        return self.rows()[0].count()

    @functools.cached_property
    def varied(self) -> set[str]:
        return set(sel.nonconstant(self.rows()[0], self.data.features))

    @functools.cached_property
    def binned(self) -> ln.Binned | None:
        """Bins of all features, for the rows of both splits."""
        if self.spec.kind != ln.FOREST or self.size <= ln.BINNED_ROWS:
            return None
        train, both = self.rows()
        return ln.Binned.of(both, train, self.data.features, self.data.label, self.data.key, "split")

    def fit(self, features: Sequence[str]) -> ln.Fitted | ln.CalibratedLinear | ln.BinnedForest:
        """The judging model on some features, trained once."""
        name = tuple(features)
        if name not in self.models:
            binned = self.binned and self.binned.where(F.col("split") == self.split[0])
            self.models[name] = ln.fit(self.spec, self.rows()[0], features, self.data.label, self.data.key, binned)
        return self.models[name]

    def __call__(self, sets: Sequence[Sequence[str]]) -> list[dict[str, float | None]]:
        keys = [tuple(sorted(s)) for s in sets]
        fresh = {k: list(s) for k, s in zip(keys, sets) if k not in self.seen}
        if fresh:
            usable = {k: [f for f in s if f in self.varied] for k, s in fresh.items()}
            self.seen |= {k: {} for k, s in usable.items() if not s}
            self._measure({k: s for k, s in usable.items() if s})
        return [self.seen[k] for k in keys]

    def _measure(self, sets: dict[tuple[str, ...], list[str]]) -> None:
        if not sets:
            return
        at_once = side_by_side(self.size, self.parallelism) if len(sets) > 1 else 1
        binned = self.binned  # written before the pool asks for it
        with ThreadPoolExecutor(at_once) as pool:
            models = list(pool.map(self.fit, sets.values()))
        if binned:
            scored = trees.scores(binned.table, [m.forest for m in models], len(binned.edges), "split", "label")
        else:
            scored = self._scored(models)
        found = {k: {} for k in sets}
        names = list(sets)
        for row in mt.all_metrics(stage(scored, "candidates"), ["candidate", "split"]).collect():
            side = "train" if row["split"] == self.split[0] else "val"
            for name, column in METRICS:
                value = row[column]
                found[names[row["candidate"]]][f"{name}_{side}"] = None if value is None else round(value, 4)
        self.seen |= found

    def _scored(self, models: Sequence[ln.Fitted | ln.CalibratedLinear | ln.BinnedForest]) -> DataFrame:
        scored = None
        for i, model in enumerate(models):
            rows = self.rows()[1].select("split", F.col(self.data.label).alias("label"), *model.features)
            part = model.score(rows).select(F.lit(i).alias("candidate"), "split", "label", "proba")
            scored = part if scored is None else scored.unionByName(part)
        return scored

    def importances(self, features: Sequence[str]) -> dict[str, float]:
        return self.fit(features).importances()


def forest_aucs(data: Dataset, features: Sequence[str], split: tuple[str, str], spec: ln.Spec = SINGLE) -> dict[str, float | None]:
    """Validation AUC of a small forest per single feature, all from one histogram; a constant one gets none."""
    p = spec.params
    found = forests.single_feature_aucs(
        data.part(split[0]), data.part(split[1]), features, data.label, data.key, int(p["n_estimators"]), int(p["max_depth"]),
        p.get("class_weight") == "balanced", int(p["seed"]),
    )
    return {f: None if v is None else round(v, 4) for f, v in found.items()}


def rank_aucs(data: Dataset, features: Sequence[str], split: tuple[str, str]) -> dict[str, float | None]:
    """Forest-free variant: the rank AUC of the raw feature, in one pass."""
    found: dict[str, float | None] = {f: None for f in features}
    for row in sel.univariate_auc(data.part(split[1]), list(features), data.label).collect():
        found[row["feature"]] = row["auc"]
    return found


def select_features(
    data: Dataset,
    judge: ln.Spec = JUDGE,
    split: tuple[str, str] = ("train", "val"),
    univariate: Callable[..., dict[str, float | None]] = forest_aucs,
    tolerance: float = sel.AUC_TOLERANCE,
) -> Selection:
    """Six steps; in each, every threshold starts from the last winner.

    A candidate that keeps a feature and loses at most the tolerance of
    validation AUC may win; its AUC becomes the next reference.  A step
    without a valid candidate changes nothing.
    """
    measure = _Judge(data, judge, split)
    train, both = measure.rows()
    features = list(data.features)
    steps: list[Row] = []
    first = measure([features])[0]
    reference = first.get("auc_val")
    steps.append(_row(0, START, "-", features, [], first, True))

    def run(step: int, candidates: list[tuple[str, list[str], list[str]]]) -> None:
        nonlocal features, reference
        method = STEPS[step - 1]
        found = measure([kept for _, kept, _ in candidates])
        winner = sel.pick([m.get("auc_val") for m in found], [len(c[1]) for c in candidates], reference, tolerance)
        for i, ((threshold, kept, removed), m) in enumerate(zip(candidates, found)):
            steps.append(_row(step, method, threshold, kept, removed, m, i == winner))
        if winner is not None:
            features, reference = candidates[winner][1], found[winner]["auc_val"]

    shares = qa.missing_shares(train, features) if features else {}
    run(1, [(str(t), *sel.by_missing(train, features, t, shares)) for t in sel.MISSING_THRESHOLDS])
    psi = sel.psi_values(both, features, F.col("split") == split[0], F.col("split") == split[1])
    run(2, [(f">{sel.PSI_THRESHOLD}_bins={sel.PSI_BINS}", *sel.by_psi(psi, features))])
    r = sel.correlation_values(train, features)
    run(3, [(str(t), *sel.by_correlation(r, features, t)) for t in sel.CORRELATION_THRESHOLDS])
    aucs = univariate(data, features, split)
    run(4, [(str(t), *sel.by_univariate(aucs, features, t)) for t in sel.UNIVARIATE_THRESHOLDS])
    run(5, [(str(sel.VARIANCE_THRESHOLD), *sel.by_variance(train, features))])
    weights = measure.importances(features) if len(features) > min(sel.TOP_IMPORTANCES) else {}
    run(6, [(f"top_{n}", *sel.by_importance(weights, features, n)) for n in sel.TOP_IMPORTANCES])

    table = data.table.sparkSession.createDataFrame([tuple(s) for s in steps], TABLE_SCHEMA)
    return Selection(features, table.drop("features_eliminadas"), sel.removed_detail(table))


def _row(step, method, threshold, kept, removed, m, chosen) -> tuple:
    values = [m.get(f"{name}_{side}") for name, _ in METRICS for side in ("train", "val")]
    return (step, method, threshold, len(kept), *values, len(removed), list(removed), bool(chosen))
