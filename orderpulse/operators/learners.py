"""MLlib learners behind one small interface: fit on rows, score rows.

Frames carry a key, a 0/1 label and plain feature columns; vectors exist only
inside the fitted pipelines.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml import Pipeline, PipelineModel
import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderpulse.operators import linear as li, trees
from orderpulse.operators.preparation import SEED, class_counts, stratified_folds, weight_column
from orderpulse.sources.sinks import write_table
from orderpulse.sources.staging import stage
from orderpulse.sources.models import load_model, save_model

LOGISTIC, FOREST, BOOSTING, SVM = "logistic", "forest", "boosting", "svm"
KINDS = (LOGISTIC, FOREST, BOOSTING, SVM)
CALIBRATION_FOLDS = 5
#: Boosting stops early above so many rows, judged on every so-many-th row by the key's hash.
EARLY_STOPPING_ROWS, HELD_OUT = 10_000, 10
#: MLlib's forests keep each row with a count per tree in memory; on more rows they are grown from bins on disk.
BINNED_ROWS = 100_000


@dataclass(frozen=True)
class Spec:
    """A learner kind with its settings."""

    kind: str
    params: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown learner {self.kind!r}; choose from {KINDS}")


@dataclass
class Fitted:
    """One or more pipelines; several are averaged (calibrated ensembles)."""

    features: list[str]
    pipelines: list[PipelineModel]
    columns: list[str]  # how each pipeline's output becomes a probability

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        """Add the probability of class 1."""
        names = []
        scored = df
        for i, (pipeline, column) in enumerate(zip(self.pipelines, self.columns)):
            name = f"_p{i}"
            scored = pipeline.transform(scored)
            value = vector_to_array(F.col("probability"))[1] if column == "probability" else F.col(column)
            keep = [c for c in scored.columns if c in df.columns or c in names]
            scored = scored.select(*keep, value.alias(name))
            names.append(name)
        total = F.col(names[0])
        for n in names[1:]:
            total = total + F.col(n)
        return scored.withColumn(out, total / len(names)).drop(*names)

    def save(self, path: str) -> None:
        for i, p in enumerate(self.pipelines):
            save_model(p, f"{path}/part-{i}")
        spark = SparkSession.getActiveSession()
        note = json.dumps({"features": self.features, "columns": self.columns})
        write_table(spark.createDataFrame([(note,)], "note string"), f"{path}/note", "json")

    @staticmethod
    def load(spark: SparkSession, paths: Sequence[str]) -> "Fitted | CalibratedLinear | BinnedForest":
        """Load the first of several folders that holds a fitted model."""
        from pyspark.errors import AnalysisException

        for path in paths:
            try:
                note = json.loads(spark.read.schema("note string").json(f"{path}/note").first()["note"])
            except AnalysisException as err:
                if "PATH_NOT_FOUND" not in str(err):
                    raise
                continue
            if "linear" in note:
                return CalibratedLinear.from_note(note)
            if "edges" in note:
                return BinnedForest.from_note(note, spark.read.parquet(f"{path}/trees"))
            parts = [load_model([f"{path}/part-{i}"]) for i in range(len(note["columns"]))]
            return Fitted(note["features"], parts, note["columns"])
        raise FileNotFoundError(f"no fitted model under any of {list(paths)}")

    def linear_weights(self) -> tuple[dict[str, float], float]:
        """Coefficients and intercept of a single logistic model."""
        model = self.pipelines[0].stages[-1]
        return dict(zip(self.features, map(float, model.coefficients))), float(model.intercept)

    def rounds(self) -> int:
        """Trees of a forest or rounds of boosting."""
        return int(self.pipelines[0].stages[-1].getNumTrees)

    def importances(self) -> dict[str, float]:
        """Forest importances, or absolute coefficients of a linear model."""
        model = self.pipelines[0].stages[-1]
        values = model.featureImportances if hasattr(model, "featureImportances") else abs(model.coefficients.toArray())
        return {f: float(values[i]) for i, f in enumerate(self.features)}


@dataclass
class CalibratedLinear:
    """Linear models whose calibrated probabilities are averaged."""

    features: list[str]
    parts: list[tuple[li.Linear, li.Calibrator]]

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        """Add the probability of class 1."""
        if all(c.kind == li.SIGMOID for _, c in self.parts):
            total = F.lit(0.0)
            for model, curve in self.parts:
                total = total + 1 / (1 + F.exp(-(self._margin(model) * curve.a + curve.b)))
            return df.withColumn(out, total / len(self.parts))
        scorer = li.Scorer(self.parts)

        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(scorer(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

        rows = F.array(*[F.col(f).cast("double") for f in self.features])
        return df.withColumn(out, F.pandas_udf(probability, "double")(rows))

    def _margin(self, model: li.Linear) -> Column:
        total = F.lit(model.intercept)
        for f, w in zip(self.features, model.weights.tolist()):
            total = total + F.col(f) * w
        return total

    def save(self, path: str) -> None:
        told = [
            {"weights": m.weights.tolist(), "intercept": m.intercept, "kind": c.kind, "a": c.a, "b": c.b, "knots": c.knots, "heights": c.heights}
            for m, c in self.parts
        ]
        spark = SparkSession.getActiveSession()
        note = json.dumps({"features": self.features, "linear": told})
        write_table(spark.createDataFrame([(note,)], "note string"), f"{path}/note", "json")

    @staticmethod
    def from_note(note: Mapping) -> "CalibratedLinear":
        parts = [
            (
                li.Linear(np.array(p["weights"]), p["intercept"]),
                li.Calibrator(p["kind"], p["a"], p["b"], p["knots"], p["heights"]),
            )
            for p in note["linear"]
        ]
        return CalibratedLinear(note["features"], parts)


@dataclass
class Binned:
    """Binned rows of a table, written once for all forests on it; ``edges`` by feature, in the order of a row's bins."""

    table: DataFrame
    edges: dict[str, np.ndarray]

    @staticmethod
    def of(rows: DataFrame, train: DataFrame, features: Sequence[str], label: str, key: str, *keep: str) -> "Binned":
        """Bins as the training rows give them."""
        edges = trees.forest_edges(train, features)
        edges = {f: edges[f] for f in features}
        return Binned(stage(trees.binned_rows(rows, edges, label, key, *keep), "binned"), edges)

    def where(self, condition: Column) -> "Binned":
        return replace(self, table=self.table.where(condition))

    def fit(self, spec: Spec, features: Sequence[str]) -> "BinnedForest":
        p, places = spec.params, {f: i for i, f in enumerate(self.edges)}
        forest = trees.fit(
            self.table, places, features, int(p.get("n_estimators", 100)), int(p.get("max_depth", 12)),
            p.get("class_weight") == "balanced", int(p.get("seed", SEED)),
        )
        return BinnedForest(list(features), self.edges, forest)


@dataclass
class BinnedForest:
    """A forest grown from bins."""

    features: list[str]
    edges: dict[str, np.ndarray]  # of every feature whose bin a row holds
    forest: trees.Forest

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        """Add the probability of class 1."""
        used, forest = [self.edges[f] for f in self.features], self.forest.scoring(list(self.edges))

        def probability(x: pd.Series) -> pd.Series:
            return pd.Series(forest.probability(trees.bins_of(np.stack(x.to_numpy()), used)) if len(x) else [], dtype=float)

        rows = F.array(*[F.col(f).cast("double") for f in self.features])
        return df.withColumn(out, F.pandas_udf(probability, "double")(rows))

    def rounds(self) -> int:
        return len(self.forest.split)

    def importances(self) -> dict[str, float]:
        return self.forest.importances()

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        rows = [
            (t, *(getattr(self.forest, name)[t].tolist() for name in ("split", "cut", "share", "gain", "used")))
            for t in range(self.rounds())
        ]
        schema = "tree int, split array<long>, cut array<int>, share array<double>, gain array<double>, used array<int>"
        write_table(spark.createDataFrame(rows, schema), f"{path}/trees")
        edges = [[f, v.tolist()] for f, v in self.edges.items()]
        note = json.dumps({"features": self.features, "depth": self.forest.depth, "edges": edges})
        write_table(spark.createDataFrame([(note,)], "note string"), f"{path}/note", "json")

    @staticmethod
    def from_note(note: Mapping, table: DataFrame) -> "BinnedForest":
        rows = sorted(table.collect(), key=lambda r: r["tree"])
        kinds = {"split": np.intp, "cut": np.uint8, "share": float, "gain": float, "used": np.int32}
        arrays = {name: np.array([r[name] for r in rows], kind) for name, kind in kinds.items()}
        forest = trees.Forest(note["features"], note["depth"], **arrays)
        return BinnedForest(note["features"], {f: np.array(v, float) for f, v in note["edges"]}, forest)


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_x")


def _estimator(spec: Spec, label: str, weight: str | None, total_weight: float, stopping: str | None = None):
    p = dict(spec.params)
    common = {"featuresCol": "_x", "labelCol": label}
    if weight:
        common["weightCol"] = weight
    if spec.kind == LOGISTIC:
        # C weighs the summed loss, regParam the mean loss
        c = float(p.get("C", 1.0))
        return LogisticRegression(
            regParam=1.0 / (c * total_weight), elasticNetParam=float(p.get("l1_ratio", 0.0)), standardization=False,
            maxIter=int(p.get("max_iter", 200)), tol=float(p.get("tol", 1e-5)), **common,
        )
    if spec.kind == FOREST:
        return RandomForestClassifier(
            numTrees=int(p.get("n_estimators", 100)), maxDepth=int(p.get("max_depth", 12)),
            seed=int(p.get("seed", SEED)), **common,
        )
    if spec.kind == BOOSTING:
        if stopping:
            common |= {"validationIndicatorCol": stopping, "validationTol": float(p.get("validation_tol", 1e-4))}
        return GBTClassifier(
            maxIter=int(p.get("max_iter", 50)), maxDepth=int(p.get("max_depth", 4)),
            stepSize=float(p.get("learning_rate", 0.1)), seed=int(p.get("seed", SEED)), **common,
        )
    raise ValueError(f"{spec.kind} is not fitted by MLlib")


def linear_problem(spec: Spec) -> li.Problem:
    """A linear learner's settings as a problem that is fitted side by side with others."""
    loss = li.LOGISTIC if spec.kind == LOGISTIC else str(spec.params.get("loss", li.SQUARED_HINGE))
    return li.Problem(loss, float(spec.params.get("C", 1.0)), spec.params.get("class_weight") == "balanced")


def calibration_method(spec: Spec) -> str:
    return str(spec.params.get("calibration_method", li.SIGMOID))


def fit(
    spec: Spec, train: DataFrame, features: Sequence[str], label: str = "satisfecho", key: str = "order_id",
    binned: Binned | None = None, folded: DataFrame | None = None,
) -> Fitted | CalibratedLinear | BinnedForest:
    """Fit one learner; ``class_weight='balanced'`` weighs classes inversely to size.

    Forests on more than BINNED_ROWS rows are grown from bins: those of ``binned``, the training rows as others have written
    them, or their own.  An SVM is calibrated on the folds of ``folded``, the training rows as ``folded_rows`` has written
    them for others, or on folds of its own.

    Boosting with ``early_stopping`` (by default on more than EARLY_STOPPING_ROWS rows) is judged after every round on a
    tenth of the rows, which it does not learn from, and stops when they get no better.
    """
    data = train.select(key, label, *features)
    if spec.kind == SVM:
        return _fit_calibrated(spec, data, list(features), label, key, folded)
    if binned and spec.kind == FOREST:
        return binned.fit(spec, features)
    balanced = spec.params.get("class_weight") == "balanced"
    # one pass serves the weights and the learner's scale
    counts = class_counts(data, label)
    if spec.kind == FOREST and counts[0] > BINNED_ROWS:
        return Binned.of(data, data, features, label, key).fit(spec, features)
    weight = None
    if balanced:
        data, weight = weight_column(data, label, "_w", counts), "_w"
    stopping = None
    if spec.kind == BOOSTING and spec.params.get("early_stopping", counts[0] > EARLY_STOPPING_ROWS):
        seed = F.lit(int(spec.params.get("seed", SEED)))
        data, stopping = data.withColumn("_held", F.pmod(F.xxhash64(key, seed), F.lit(HELD_OUT)) == 0), "_held"
    # balanced weights sum to the row count as well
    pipeline = Pipeline(stages=[_assembler(features), _estimator(spec, label, weight, float(counts[0]), stopping)]).fit(data)
    return Fitted(list(features), [pipeline], ["probability"])


def logistic_gradient(
    model: Fitted, spec: Spec, train: DataFrame, label: str = "satisfecho"
) -> dict[str, float]:
    """Gradient of the mean loss with its ridge penalty, per feature; near zero at the optimum."""
    weights, intercept = model.linear_weights()
    counts = class_counts(train, label)
    data = train.withColumn("_w", F.lit(1.0))
    if spec.params.get("class_weight") == "balanced":
        data = weight_column(train, label, "_w", counts)
    margin = F.lit(intercept)
    for f, w in weights.items():
        margin = margin + F.col(f) * F.lit(w)
    gap = F.col("_w") * (1 / (1 + F.exp(-margin)) - F.col(label))
    row = data.select(gap.alias("_g"), *weights).agg(*[F.sum(F.col("_g") * F.col(f)) for f in weights]).first()
    c = float(spec.params.get("C", 1.0))
    return {f: (row[i] + w / c) / counts[0] for i, (f, w) in enumerate(weights.items())}


def folded_rows(train: DataFrame, features: Sequence[str], label: str, key: str, folds: int, seed: int = SEED) -> DataFrame:
    """Rows with stratified folds as linear fits read them, written once: every step of a fit scans them."""
    dealt = stratified_folds(train.select(key, label, *features), label, key, folds, seed)
    return stage(li.feature_rows(dealt, features, label, "fold", key), "folds")


def _fit_calibrated(spec, data, features, label, key, folded=None) -> CalibratedLinear:
    """A linear SVM per fold, calibrated on the rows it did not see, averaged.

    Class weights shape the SVM only; the calibrator sees plain rows.
    """
    rows = folded or folded_rows(data, features, label, key, CALIBRATION_FOLDS)
    scorer = li.calibrated(rows, [linear_problem(spec)], [calibration_method(spec)], CALIBRATION_FOLDS, len(features))[0]
    return CalibratedLinear(features, scorer.parts)
