import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderpulse.operators import learners as ln, linear as li
from orderpulse.plans import training
from orderpulse.plans.dataset import Dataset


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 1200
    pdf = pd.DataFrame({
        "order_id": np.arange(n), "split": np.where(np.arange(n) % 4 < 3, "train", "val"), "a": rng.normal(0, 1, n),
        "b": rng.normal(0, 1, n), "few": rng.integers(0, 5, n).astype(float),
    })
    pdf["satisfecho"] = ((pdf.a > 0) ^ (rng.random(n) < 0.1)).astype(int)
    return pdf, spark.createDataFrame(pdf).repartition(3).localCheckpoint()


def test_a_round_of_the_search_deals_folds_once(frame, monkeypatch):
    pdf, df = frame
    extra = df.withColumn("split", F.when(F.col("order_id") % 8 == 3, "backtest").otherwise(F.col("split")))
    dealt, real = [], ln.stratified_folds
    monkeypatch.setattr(ln, "stratified_folds", lambda *a: dealt.append(1) or real(*a))
    monkeypatch.setattr(training, "stratified_folds", lambda *a: dealt.append(1) or real(*a))
    data = Dataset(extra, ["a", "b", "few"])
    spaces = {name: training.SPACES[name] for name in ("Logistic Regression", "LinearSVC")}
    tuned = training.tune(data, spaces, trials=2)
    assert len(dealt) == 1 and {r["folds"] for r in tuned.cv.collect()} == {5}
    # the first step's sums of models that differ in C only are worked out once, and serve all of them
    counted, sums = [], li._sums
    monkeypatch.setattr(li, "_sums", lambda rows, problems, *a: counted.append(len(problems)) or sums(rows, problems, *a))
    rows = ln.folded_rows(df, data.features, "satisfecho", "order_id", 5)
    many = li.fit_many(rows, [li.Problem(li.SQUARED_HINGE, c) for c in (0.01, 0.1, 1.0, 10.0)], 3)
    assert 4 not in counted and all(m.slope < li.FLAT for m in many)
