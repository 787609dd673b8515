import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderpulse.operators import ordering as od, preparation as pr, quantiles as qn


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value, values cluster, both zeros occur."""
    rng = np.random.default_rng(5)
    n = 3000
    v = np.where(rng.random(n) < 1 / 3, 0.5, np.round(rng.normal(0.5, 1e-3, n), 5))
    v[:3] = [0.0, -0.0, 0.0]
    pdf = pd.DataFrame({"id": np.arange(n), "g": rng.choice(["a", "b"], n), "v": v, "y": rng.integers(0, 2, n)})
    return pdf, spark.createDataFrame(pdf).repartition(3)


def test_running_totals_match_a_plain_sort(skewed):
    pdf, df = skewed
    got = od.running_totals(df, "v", {"c": F.lit(1), "y": F.col("y")}, by=["g"]).toPandas()
    want = pdf.assign(v=pdf.v + 0.0).groupby(["g", "v"]).agg(c=("y", "size"), y=("y", "sum")).reset_index()
    want["c_cum"] = want.groupby("g").c.cumsum()
    want["y_cum"] = want.groupby("g").y.cumsum()
    merged = got.merge(want, on=["g", "v"], suffixes=("", "_w"))
    assert len(merged) == len(want) == len(got)
    for c in ("c", "y", "c_cum", "y_cum"):
        assert (merged[c] == merged[f"{c}_w"]).all()
    assert set(got[got.g == "a"].c_all) == {float((pdf.g == "a").sum())}


def test_running_totals_descending(skewed):
    pdf, df = skewed
    got = od.running_totals(df, "v", {"c": F.lit(1)}, descending=True).toPandas().sort_values("v", ascending=False)
    assert (got.c_cum.to_numpy() == got.c.cumsum().to_numpy()).all()
    assert got.c_cum.iloc[-1] == len(pdf)


def test_results_do_not_depend_on_the_number_of_ranges(skewed, monkeypatch):
    pdf, df = skewed
    frames = []
    for n in (od.RANGE_ROWS, 50):
        monkeypatch.setattr(od, "RANGE_ROWS", n)
        totals = od.running_totals(df, "v", {"c": F.lit(1)}, by=["g"])
        frames.append(od.with_lower(totals, ["g"], "v", ["c"]).select("*", "lower.c").drop("lower").orderBy("g", "v").toPandas())
        got = od.positions(df, [F.col("v").desc(), F.col("id")], by=["g"]).toPandas().sort_values(["g", "pos"])
        want = pdf.sort_values(["g", "v", "id"], ascending=[True, False, True])
        assert got.id.tolist() == want.id.tolist()
    pd.testing.assert_frame_equal(*frames)


def test_missing_and_nan_values_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (1.0,)], "v double")
    rows = od.running_totals(df, "v", {"c": F.lit(1)}).collect()
    assert [(r.v, r.c, r.c_all) for r in rows] == [(1.0, 2.0, 2.0)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "v double, g string")
    assert od.running_totals(df, "v", {"c": F.lit(1)}, by=["g"]).count() == 0


def test_positions_number_rows_within_groups(skewed):
    pdf, df = skewed
    got = od.positions(df, [F.col("v"), F.col("id")], by=["g"], sums={"y": F.col("y")}).toPandas()
    got = got.sort_values(["g", "v", "id"])
    assert (got.groupby("g").cumcount() + 1 == got.pos).all()
    assert (got.groupby("g").y.cumsum() == got.y_cum).all()
    assert (got.groupby("g").y.transform("size") == got.n).all()


def test_latest_per_key_prefers_dated_then_largest_id(spark):
    rows = [(1, "a", 5, "x"), (1, "b", 5, "y"), (1, "c", None, "z"), (2, "d", None, "w")]
    df = spark.createDataFrame(rows, "k int, id string, t int, v string")
    got = od.latest_per_key(df, ["k"], [F.col("t").desc_nulls_last(), F.col("id").desc()])
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "y"), (2, "w")]


def test_latest_per_key_cuts_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    plan = od.latest_per_key(df, ["k"], [F.col("t").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_running_max_and_seeded_sample(spark):
    df = spark.createDataFrame([("m", i, v) for i, v in enumerate([0.1, 0.3, 0.2, 0.4])], "m string, t int, v double")
    got = od.running_max(df, ["m"], [F.col("t")], "v", "best").orderBy("t").collect()
    assert [r.best for r in got] == [0.1, 0.3, 0.3, 0.4]
    big = spark.range(1000)
    one, two = (sorted(r.id for r in od.seeded_sample(big.repartition(k), "id", 50, 7).collect()) for k in (1, 5))
    assert one == two and len(one) == 50


@pytest.mark.parametrize("read, cells", [(100_000, 4_096), (10, 4_096), (0, 3)])
def test_quantiles_are_exact(skewed, monkeypatch, read, cells):
    """Read at once, after some histograms, and narrowed to single values."""
    monkeypatch.setattr(qn, "READ", read)
    monkeypatch.setattr(qn, "CELLS", cells)
    pdf, df = skewed
    probs = [0.0, 0.01, 0.25, 0.3337, 0.5, 0.75, 0.99, 1.0]
    got = qn.exact_quantiles(df, ["v", "id"], probs)
    for c in ("v", "id"):
        assert np.allclose(got[c], np.quantile(pdf[c], probs), rtol=0, atol=1e-12)


@pytest.mark.parametrize("read", [100_000, 0])
def test_quantiles_of_extreme_values(spark, monkeypatch, read):
    monkeypatch.setattr(qn, "READ", read)
    values = [-1.7e308, -5e-324, 0.0, -0.0, 5e-324, 1.0, float(np.nextafter(1.0, 2.0)), 1.7e308, -3.0, -3.0, -3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(2)
    probs = [k / (len(values) - 1) for k in range(len(values))]
    assert qn.exact_quantiles(df, ["v"], probs)["v"] == sorted(v + 0.0 for v in values)


def test_values_in_order_as_whole_numbers():
    rng = np.random.default_rng(1)
    v = np.sort(rng.normal(0, 1, 200) * 10.0 ** rng.integers(-300, 300, 200))
    assert (np.diff(qn.ordered(v)) > 0).all()
    assert (qn.ordered(qn.ordered(v)).view(float) == v).all()


def test_a_task_reads_a_bounded_number_of_rows(spark, monkeypatch):
    """Ten times the rows: no more values are read, and no scan sends more."""
    seen = []
    real = qn._read
    monkeypatch.setattr(qn, "_read", lambda v, b, f: (seen.append(sum(x.inside for x in b)), real(v, b, f)))
    monkeypatch.setattr(qn, "READ", 500)
    for n in (20_000, 200_000):
        df = spark.range(n).select((F.rand(3) * 1000).alias("v"))
        assert qn.exact_quantiles(df, ["v"], [0.5])["v"][0] == pytest.approx(500, abs=20)
    assert all(s <= 500 for s in seen)


def test_quantiles_of_odd_columns(spark):
    df = spark.createDataFrame(
        [(float(i), None, 7.0, float("nan") if i == 1 else float(i)) for i in range(1, 11)] + [(None, None, 7.0, None)],
        "a double, empty double, flat double, nan double",
    )
    got = qn.exact_quantiles(df, ["a", "empty", "flat", "nan"], [0.01, 0.5])
    assert qn.exact_quantiles(df.limit(0), ["a"], [0.5]) == {"a": [None]}
    assert got["a"] == pytest.approx([1.09, 5.5])
    assert got["empty"] == [None, None]
    assert got["flat"] == [7.0, 7.0]
    assert got["nan"] == pytest.approx([2.08, 6.0])


def test_grouped_quantiles(skewed):
    pdf, df = skewed
    got = qn.quantiles_by_group(df, ["g"], "v", [0.05, 0.5]).toPandas().set_index("g").sort_index()
    want = pdf.groupby("g").v.quantile([0.05, 0.5]).unstack()
    assert np.allclose(got.to_numpy(), want.to_numpy(), atol=1e-12)


def test_folds_are_even_within_classes_and_repeatable(spark):
    df = spark.range(103).selectExpr("id AS order_id", "cast(id % 3 = 0 AS int) AS satisfecho")
    folds = pr.stratified_folds(df.repartition(3)).toPandas()
    assert len(folds) == 103
    for _, part in folds.groupby("satisfecho"):
        sizes = part.fold.value_counts()
        assert len(sizes) == 5 and sizes.max() - sizes.min() <= 1
    again = pr.stratified_folds(df).toPandas()
    key = lambda f: dict(zip(f.order_id, f.fold))
    assert key(folds) == key(again)
    assert key(pr.stratified_folds(df, seed=1).toPandas()) != key(folds)


def test_a_hot_value_is_spread_over_ranges(spark, monkeypatch):
    """All rows tie on the score: the key still splits them, and numbering holds."""
    monkeypatch.setattr(od, "RANGE_ROWS", 500)
    df = spark.range(4000).selectExpr("id", "0.5D AS v", "cast(id % 7 = 0 AS int) AS y").repartition(4)
    ranged = df.repartitionByRange(od.range_count(df), "v", "id").withColumn("r", F.spark_partition_id())
    assert ranged.select("r").distinct().count() > 1
    got = od.positions(df, [F.col("v"), F.col("id")], sums={"y": F.col("y")})
    assert got.where("pos <> id + 1 OR n <> 4000").count() == 0
    assert got.where("y_cum <> floor(id / 7) + 1").count() == 0


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Context:
    def __init__(self, folder):
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder


class _Session:
    def __init__(self, folder=None, **settings):
        self.conf = _Conf({k.replace("_", "."): v for k, v in settings.items()})
        self.sparkContext = _Context(folder)


def test_clusters_must_name_a_shared_folder():
    from orderpulse.sources.staging import shared_folder

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session(spark_master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session(spark_master="local-cluster[2,1,1024]"))
    assert shared_folder(_Session("/shared/y", spark_master="yarn")) == "/shared/y"
    assert shared_folder(_Session(spark_master="yarn", spark_checkpoint_dir="/shared/x/")) == "/shared/x"
    assert shared_folder(_Session(spark_master="local[2]"))
