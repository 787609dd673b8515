import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderpulse.operators import preparation as pr

T = dt.datetime


def test_cutoffs_end_at_their_midnight(spark):
    rows = [
        ("a", T(2017, 12, 31)), ("b", T(2017, 12, 31, 0, 0, 1)), ("c", T(2018, 1, 1)), ("d", T(2018, 3, 31)),
        ("e", T(2018, 6, 30)), ("f", T(2018, 6, 30, 5)), ("g", None),
    ]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(rows, f"k string, order_purchase_timestamp {kind}")
        got = {r.k: r.split for r in pr.temporal_split(df).collect()}
        assert got == {"a": "train", "b": "val", "c": "val", "d": "val", "e": "backtest", "f": "live", "g": None}


def test_split_summary(spark):
    df = spark.createDataFrame(
        [("train", T(2017, 1, 2), 1), ("train", T(2017, 11, 2), 0), ("val", T(2018, 1, 2), 1)],
        "split string, order_purchase_timestamp timestamp_ntz, satisfecho int",
    )
    rows = {r.split: (r.n_rows, r.first_month, r.last_month, r.target_rate) for r in pr.split_summary(df).collect()}
    assert rows == {"train": (2, "2017-01", "2017-11", 0.5), "val": (1, "2018-01", "2018-01", 1.0)}


def test_target_encoding_uses_training_rows_only(spark):
    rows = [("a", "train", 1), ("a", "train", 0), ("b", "train", 1), (None, "train", 1), ("a", "val", 1), ("z", "val", 0), (None, "val", 0)]
    df = spark.createDataFrame(rows, "product_category_name_english string, split string, satisfecho int")
    out = pr.target_encode(df)
    assert "product_category_name_english" not in out.columns
    got = sorted((r.split, r.satisfecho, r.te_product_category_name_english) for r in out.collect())
    assert got == [
        ("train", 0, 0.5), ("train", 1, 0.5), ("train", 1, 0.75), ("train", 1, 1.0),
        ("val", 0, 0.75), ("val", 0, 0.75), ("val", 1, 0.5),
    ]


def test_scaler_uses_the_population_deviation(spark):
    rows = [("train", float(i), 3.0) for i in range(5)] + [("val", 10.0, 4.0)]
    df = spark.createDataFrame(rows, "split string, x double, flat double")
    out = pr.standardize(df, ["x", "flat"])
    val = out.where("split = 'val'").first()
    assert val.x == pytest.approx((10 - 2) / np.std(range(5))) and val.flat == 1.0
    train = out.where("split = 'train'").agg(F.avg("x"), F.stddev_pop("x")).first()
    assert train[0] == pytest.approx(0) and train[1] == pytest.approx(1)


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(0,)] * 2, "satisfecho int")
    got = {r.satisfecho: (r.n, r.weight, r.ratio_to_other) for r in pr.class_weights(df).collect()}
    assert got == {1: (6, pytest.approx(8 / 12), 3.0), 0: (2, 2.0, pytest.approx(1 / 3))}
    weighed = pr.weight_column(df).groupBy("satisfecho").agg(F.sum("weight").alias("w")).collect()
    assert [r.w for r in weighed] == pytest.approx([4.0, 4.0])


def test_left_over_text_goes(spark):
    df = spark.createDataFrame([("k", "train", "SP", 1.0)], "order_id string, split string, customer_state string, x double")
    assert pr.drop_text(df, keep=("order_id", "split")).columns == ["order_id", "split", "x"]
    assert pr.numeric_columns(df) == ["x"]
