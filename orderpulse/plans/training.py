"""Baselines, hyper-parameter search, cross-validation and stacking."""

from __future__ import annotations

import functools
import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from orderpulse.operators import learners as ln, linear as li, metrics as mt
from orderpulse.operators.preparation import SEED, stratified_folds
from orderpulse.plans.dataset import Dataset
from orderpulse.sources.staging import stage

FOLDS = 5
TRIALS = 100

BASELINES: dict[str, ln.Spec] = {
    "Logistic Regression": ln.Spec(ln.LOGISTIC, {"C": 1.0}),
    "Random Forest": ln.Spec(ln.FOREST, {"n_estimators": 100}),
    "linearSVM": ln.Spec(ln.SVM, {"C": 1.0, "calibration_method": "sigmoid"}),
    "Gradient Boosting": ln.Spec(ln.BOOSTING, {"max_iter": 100}),
}


def _log_uniform(rng: random.Random, low: float, high: float) -> float:
    return math.exp(rng.uniform(math.log(low), math.log(high)))


# Search ranges per learner.  The solver of linear models and settings of boosting
# that MLlib lacks (leaf count, l2) are left out.
SPACES: dict[str, Callable[[random.Random], ln.Spec]] = {
    "Logistic Regression": lambda rng: ln.Spec(
        ln.LOGISTIC, {"C": _log_uniform(rng, 1e-3, 10), "class_weight": rng.choice([None, "balanced"])}
    ),
    "Gradient Boosting": lambda rng: ln.Spec(
        ln.BOOSTING,
        {
            "max_iter": rng.randint(100, 500), "max_depth": rng.randint(2, 8),
            "learning_rate": _log_uniform(rng, 1e-3, 0.3), "class_weight": rng.choice(["balanced", None]),
            "early_stopping": True,
        },
    ),
    "LinearSVC": lambda rng: ln.Spec(
        ln.SVM,
        {
            "C": _log_uniform(rng, 1e-3, 100), "loss": rng.choice([li.HINGE, li.SQUARED_HINGE]),
            "class_weight": rng.choice([None, "balanced"]),
            "calibration_method": rng.choice(["sigmoid", "isotonic"]),
        },
    ),
}


def score_models(data: Dataset, models: Mapping[str, ln.Fitted], splits: Sequence[str]) -> DataFrame:
    """Scores of every model on the splits, in long form, written once."""
    rows = data.part(*splits)
    out = None
    for name, model in models.items():
        part = model.score(rows.select(data.key, "split", F.col(data.label).alias("label"), *model.features)).select(
            F.lit(name).alias("model"), data.key, "split", "label", "proba"
        )
        out = part if out is None else out.unionByName(part)
    return stage(out, "scores")


@dataclass
class Baseline:
    models: dict[str, ln.Fitted]
    scores: DataFrame
    metrics: DataFrame
    overfit: DataFrame
    thresholds: DataFrame
    leaderboard: DataFrame


def train_baselines(
    data: Dataset, specs: Mapping[str, ln.Spec] = BASELINES, splits: tuple[str, str] = ("train", "val")
) -> Baseline:
    """Fit every model on the training rows; measure all of them in one pass."""
    train = data.part(splits[0])
    models = {name: ln.fit(spec, train, data.features, data.label, data.key) for name, spec in specs.items()}
    scores = score_models(data, models, splits)
    metrics = stage(mt.all_metrics(scores, ["model", "split"]), "metrics")
    overfit = mt.overfit_flags(metrics, ["model"], "split", *splits)
    sweep = mt.threshold_sweep(
        scores.where(F.col("split") == splits[1]), mt.GRID_BASELINE, ["model"], zero_degenerate=True
    )
    val = metrics.where(F.col("split") == splits[1])
    thresholds = (
        mt.best_threshold(sweep, ["model"])
        .join(val.select("model", "f1_1"), "model")
        .select("model", "threshold", "f1", (F.col("f1") - F.col("f1_1")).alias("delta_f1"), "precision", "recall")
    )
    return Baseline(models, scores, metrics, overfit, thresholds, mt.leaderboard(val, "model"))


@dataclass
class Trial:
    number: int
    spec: ln.Spec
    value: float


def _is_linear(spec: ln.Spec) -> bool:
    return spec.kind == ln.SVM or (spec.kind == ln.LOGISTIC and not spec.params.get("l1_ratio"))


def _f1(cells: Sequence[float], pos_label: int) -> float:
    """F1 of one class from ``tn, fp, fn, tp``."""
    tn, fp, fn, tp = (float(c) for c in cells)
    hit = tp if pos_label else tn
    return 2 * hit / (2 * hit + fp + fn) if hit else 0.0


def linear_scorers(rows: DataFrame, specs: Sequence[ln.Spec], folds: int, d: int) -> list[li.Scorer]:
    """Scorers of linear learners, all logistic models fitted together and all SVMs together."""
    out: dict[int, li.Scorer] = {}
    logistic = [i for i, s in enumerate(specs) if s.kind == ln.LOGISTIC]
    others = [i for i, s in enumerate(specs) if s.kind == ln.SVM]
    if logistic:
        out |= zip(logistic, li.plain(rows, [ln.linear_problem(specs[i]) for i in logistic], d))
    if others:
        problems, methods = [ln.linear_problem(specs[i]) for i in others], [ln.calibration_method(specs[i]) for i in others]
        out |= zip(others, li.calibrated(rows, problems, methods, folds, d))
    return [out[i] for i in range(len(specs))]


def search_rounds(
    data: Dataset, spaces: Mapping[str, Callable[[random.Random], ln.Spec]], trials: int | Mapping[str, int] = TRIALS,
    pos_labels: Sequence[int] = (0, 1), seed: int = SEED, splits: tuple[str, str] = ("train", "val"), parallelism: int = 4,
    folded: DataFrame | None = None,
) -> dict[int, dict[str, list[Trial]]]:
    """Seeded random search for the highest F1 of each class on the validation rows.

    What a round per class would fit is the same, so every draw is fitted once and measured for all classes.  Draws of
    linear learners are fitted side by side, a scan of the rows per step for all of them; others are a distributed fit
    each, a few at a time.  ``folded`` are the training rows with the folds of a calibration, where they are written already.
    """
    count = lambda name: trials if isinstance(trials, int) else trials[name]
    drawn = []
    for name, space in spaces.items():
        rng = random.Random(seed)
        drawn += [(name, k, space(rng)) for k in range(count(name))]
    train, val = data.part(splits[0]), data.part(splits[1])
    cells: dict[int, Sequence[float]] = {}
    together = [i for i, (_, _, spec) in enumerate(drawn) if _is_linear(spec)]
    if together:
        rows = folded or ln.folded_rows(train, data.features, data.label, data.key, ln.CALIBRATION_FOLDS)
        unseen = stage(li.feature_rows(val, data.features, data.label), "unseen")
        scorers = linear_scorers(rows, [drawn[i][2] for i in together], ln.CALIBRATION_FOLDS, len(data.features))
        cells |= zip(together, li.confusions(unseen, scorers).tolist())

    def run(i: int) -> Sequence[float]:
        model = ln.fit(drawn[i][2], train, data.features, data.label, data.key)
        scored = model.score(val.select(F.col(data.label).alias("label"), *data.features))
        row = mt.confusion(scored).first()
        return [row[c] for c in ("tn", "fp", "fn", "tp")]

    alone = [i for i in range(len(drawn)) if i not in cells]
    with ThreadPoolExecutor(parallelism) as pool:
        cells |= zip(alone, pool.map(run, alone))
    out: dict[int, dict[str, list[Trial]]] = {c: {name: [] for name in spaces} for c in pos_labels}
    for i, (name, number, spec) in enumerate(drawn):
        for c in pos_labels:
            out[c][name].append(Trial(number, spec, _f1(cells[i], c)))
    return out


def search(
    data: Dataset, space: Callable[[random.Random], ln.Spec], trials: int = TRIALS, pos_label: int = 0,
    seed: int = SEED, splits: tuple[str, str] = ("train", "val"), parallelism: int = 4,
) -> list[Trial]:
    """One learner, one class."""
    return search_rounds(data, {"": space}, trials, [pos_label], seed, splits, parallelism)[pos_label][""]


def best_trial(trials: Sequence[Trial]) -> Trial:
    return max(trials, key=lambda t: t.value)


def trial_history(data: Dataset, runs: Mapping[str, Sequence[Trial]]) -> DataFrame:
    """Value and best value so far per trial."""
    from orderpulse.operators.ordering import running_max

    rows = [(name, t.number, t.value) for name, trials in runs.items() for t in trials]
    table = data.table.sparkSession.createDataFrame(rows, "model string, trial int, value double")
    return running_max(table, ["model"], [F.col("trial")], "value", "best")


def search_table(spark, rounds: Mapping[int, Mapping[str, Sequence[Trial]]]) -> DataFrame:
    """One row per class, learner and draw, with its settings and the best value so far."""
    from orderpulse.operators.ordering import running_max

    rows = [
        (
            c, name, t.number, float(t.spec.params.get("C", 0.0)) or None, t.spec.params.get("class_weight"),
            t.spec.params.get("loss"), t.spec.params.get("calibration_method"), t.value,
        )
        for c, runs in rounds.items() for name, trials in runs.items() for t in trials
    ]
    schema = "pos_label int, model string, trial int, c double, class_weight string, loss string, calibration string, f1 double"
    return running_max(spark.createDataFrame(rows, schema), ["pos_label", "model"], [F.col("trial")], "f1", "best")


def out_of_fold(
    data: Dataset, specs: Mapping[str, ln.Spec], split: str = "train", folds: int = FOLDS, seed: int = SEED,
    parallelism: int = 4, folded: DataFrame | None = None,
) -> DataFrame:
    """Every training row scored by a model that did not see its fold, per model.

    Linear learners are fitted side by side over all folds and score all rows in one scan; within a fold's training rows an
    SVM is calibrated on the other folds in turn.  ``folded`` are the rows with these folds as linear fits read them, where
    they are written already.
    """
    linear = [name for name, spec in specs.items() if _is_linear(spec)]
    parts = []
    if linear:
        fitted_on = folded or ln.folded_rows(data.part(split), data.features, data.label, data.key, folds, seed)
        scorers: dict[str, dict[int, li.Scorer]] = {name: {} for name in linear}
        for kind in (ln.LOGISTIC, ln.SVM):
            jobs = [(name, k) for name in linear if specs[name].kind == kind for k in range(folds)]
            problems = [replace(ln.linear_problem(specs[name]), outer=k) for name, k in jobs]
            if kind == ln.LOGISTIC:
                found = li.plain(fitted_on, problems, len(data.features)) if jobs else []
            else:
                methods = [ln.calibration_method(specs[name]) for name, _ in jobs]
                found = li.calibrated(fitted_on, problems, methods, folds, len(data.features)) if jobs else []
            for (name, k), scorer in zip(jobs, found):
                scorers[name][k] = scorer
        parts.append(li.fold_scores(fitted_on, scorers, data.key))
    alone = [(name, spec, k) for name, spec in specs.items() if name not in linear for k in range(folds)]
    if alone:
        rows = stage(stratified_folds(data.part(split), data.label, data.key, folds, seed), "folds")
        with ThreadPoolExecutor(parallelism) as pool:
            models = pool.map(
                lambda job: ln.fit(job[1], rows.where(F.col("fold") != job[2]), data.features, data.label, data.key), alone
            )
        for (name, _, k), model in zip(alone, models):
            held = rows.where(F.col("fold") == k)
            columns = [data.key, "fold", F.col(data.label).cast("int").alias("label"), *data.features]
            parts.append(model.score(held.select(*columns)).select(F.lit(name).alias("model"), data.key, "fold", "label", "proba"))
    return stage(functools.reduce(DataFrame.unionByName, parts), "oof")


def cv_summary(oof: DataFrame, pos_label: int = 0) -> DataFrame:
    """Mean and population deviation of the fold F1 per model."""
    by = ["model", "fold"]
    scores = mt.class_metrics(mt.confusion(oof, by), by)
    return scores.groupBy("model").agg(
        F.count("*").alias("folds"), F.avg(f"f1_{pos_label}").alias("cv_f1_mean"),
        F.stddev_pop(f"f1_{pos_label}").alias("cv_f1_std"),
    )


@dataclass
class Tuned:
    trials: dict[str, list[Trial]]
    models: dict[str, ln.Fitted]
    cv: DataFrame
    metrics: DataFrame
    stacked: DataFrame


def tune(
    data: Dataset, spaces: Mapping[str, Callable[[random.Random], ln.Spec]] = SPACES,
    trials: int | Mapping[str, int] = TRIALS, pos_label: int = 0, seed: int = SEED, splits: tuple[str, ...] = ("train", "val", "backtest"), parallelism: int = 4,
    folds: int = FOLDS,
) -> Tuned:
    """Search, cross-validate and refit each learner, then stack them.

    Metrics cover the validation and later splits at the 0.5 cut.
    """
    train = data.part(splits[0])
    # search, cross-validation and refit deal the same folds, which are written once
    shared = ln.folded_rows(train, data.features, data.label, data.key, ln.CALIBRATION_FOLDS)
    runs = search_rounds(data, spaces, trials, [pos_label], seed, splits[:2], parallelism, shared)[pos_label]
    specs = {n: best_trial(t).spec for n, t in runs.items()}
    same = shared if (folds, seed) == (ln.CALIBRATION_FOLDS, SEED) else None
    oof = out_of_fold(data, specs, splits[0], folds, seed, parallelism, same)
    models = {n: ln.fit(spec, train, data.features, data.label, data.key, folded=shared) for n, spec in specs.items()}
    scores = score_models(data, models, splits[1:])
    metrics = mt.all_metrics(scores, ["model", "split"])
    return Tuned(runs, models, cv_summary(oof, pos_label), metrics, stack(oof, scores, list(specs), data.key))


def _wide(scores: DataFrame, names: Sequence[str], keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """One probability column per model (a pivot over the known model names)."""
    columns = [f"m{i}" for i in range(len(names))]
    picks = [F.max(F.when(F.col("model") == n, F.col("proba"))).alias(c) for n, c in zip(names, columns)]
    return scores.groupBy(*keys).agg(*picks), columns


def stack(oof: DataFrame, scores: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """Metrics per split of a balanced logistic model on the models' probabilities.

    It is fitted on out-of-fold probabilities and applied to the refitted models'.
    """
    seen, columns = _wide(oof, names, [key, "label"])
    meta = ln.fit(ln.Spec(ln.LOGISTIC, {"C": 1.0, "class_weight": "balanced"}), seen, columns, "label", key)
    unseen, _ = _wide(scores, names, [key, "split", "label"])
    return mt.all_metrics(meta.score(unseen), ["split"])


def best_of(metrics: DataFrame, metric: str) -> DataFrame:
    return mt.best_model(metrics, "model", metric)
