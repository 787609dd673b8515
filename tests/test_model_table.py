"""Steps of the model table that leave rows out early or take many columns at once."""

import pytest
from pyspark.sql import functions as F

from orderpulse.operators import features as ft, preparation as pr, quality as qa, quantiles as qn
from orderpulse.operators.arrays import per_column


def _items(spark):
    rows = [("a", 1, 10, "s1", 5.0, 1.0), ("a", 2, 11, "s2", 7.0, 1.0), ("a", 3, 12, None, 7.0, 1.0), ("b", 1, 10, "s1", 1.0, 0.5), (None, 1, 10, "s1", 1.0, 0.5)]
    return spark.createDataFrame(rows, "order_id string, order_item_id int, product_id long, seller_id string, price double, freight_value double")


def test_items_and_payments_of_listed_orders_only(spark):
    items = _items(spark)
    orders = spark.createDataFrame([("b",), ("b",), ("z",), (None,)], "order_id string")
    got = ft.summarize_items(items, orders)
    assert [(r["order_id"], r["total_price"], r["unique_sellers"]) for r in got.collect()] == [("b", 1.0, 1)]
    everything = ft.summarize_items(items)
    assert {r["order_id"]: (r["unique_sellers"], r["product_id"]) for r in everything.collect()} == {"a": (2, 11), "b": (1, 10)}
    paid = spark.createDataFrame([("a", 1, "card", 1, 2.0), ("b", 1, None, 1, 3.0)], "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    assert [(r["order_id"], r["payment_types_count"]) for r in ft.summarize_payments(paid, orders).collect()] == [("b", 0)]


def test_cells_are_aggregated_by_position(spark):
    df = spark.createDataFrame([(1.0, None, 3), (3.0, None, 3)], "a double, b double, c int")
    assert qa.missing_counts(df) == (2, {"b": 2})
    assert qa.missing_counts(df.limit(0)) == (0, {})
    assert pr.fit_scaler(df, ["a", "b", "c"]) == {"a": (2.0, 1.0), "b": (0.0, 1.0), "c": (3.0, 1.0)}
    assert pr.fit_scaler(df.limit(0), ["a"]) == {"a": (0.0, 1.0)}
    assert per_column(df.limit(0), [F.col("a")], F.count("v").alias("n")) == {}


def test_histograms_place_values_of_several_brackets_of_a_column(spark, monkeypatch):
    monkeypatch.setattr(qn, "READ", 20)
    values = [float(v * v % 1009 - 500) for v in range(3000)]
    df = spark.createDataFrame([(v, -v) for v in values], "v double, w double")
    got = qn.exact_quantiles(df, ["v", "w"], [0.0, 0.01, 0.25, 0.5, 0.99, 1.0])
    ordered = sorted(values)
    for p, q in zip([0.0, 0.01, 0.25, 0.5, 0.99, 1.0], got["v"]):
        k = p * (len(values) - 1)
        low, high = ordered[int(k)], ordered[min(len(values) - 1, int(k) + 1)]
        assert q == pytest.approx(low + (high - low) * (k - int(k)))
    assert got["w"][3] == pytest.approx(-got["v"][3])
