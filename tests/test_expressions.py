import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderpulse.functions import expressions as ex

D = dt.datetime


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_flags_read_unknown_as_no(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1e-9,), (-1.0,)], "x double")
    assert values(df, ex.flag(F.col("x") <= 0)) == [0, 1, 0, 1]


def test_equality_flag_ignores_missing_sides(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "a string, b string")
    assert values(df, ex.flag(F.col("a") == F.col("b"))) == [1, 0, 0, 0]


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (None, 2.0), (0.0, 3.0)], "n double, d double")
    assert values(df, ex.ratio(F.col("n"), F.col("d"))) == [None, None, None, 0.0]
    guarded = values(df, ex.guarded_ratio(F.col("n"), F.col("d")))
    assert guarded[0] == 0.0 and guarded[1] == pytest.approx(5e9) and guarded[3] == 0.0


def test_day_spans_floor_towards_minus_infinity(spark):
    base = D(2018, 1, 10)
    rows = [(base, base + dt.timedelta(days=x)) for x in (-0.5, -1.0, 0, 0.99, 1.0)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz").coalesce(1)
    assert values(df, ex.whole_days_between(F.col("a"), F.col("b"))) == [-1, -1, 0, 0, 1]
    assert values(df, ex.days_between(F.col("a"), F.col("b"))) == [-0.5, -1.0, 0.0, 0.99, 1.0]


def test_one_microsecond_late_counts_for_exact_spans_only(spark):
    a = D(2018, 1, 10)
    df = spark.createDataFrame([(a, a + dt.timedelta(microseconds=1))], "a timestamp_ntz, b timestamp_ntz")
    assert values(df, ex.flag(ex.days_between(F.col("a"), F.col("b")) > 0)) == [1]
    assert values(df, ex.flag(ex.whole_days_between(F.col("a"), F.col("b")) > 0)) == [0]


def test_weekday_starts_on_monday(spark):
    df = spark.createDataFrame([(D(2018, 1, 1),), (D(2018, 1, 7),)], "t timestamp_ntz").coalesce(1)
    assert values(df, F.weekday("t")) == [0, 6]


def test_bad_dates_become_missing(spark):
    df = spark.createDataFrame([("",), ("x",), ("2018-02-30",), ("2018-02-28 10:00:00",), (None,)], "t string").coalesce(1)
    assert [v is None for v in values(df, ex.try_timestamp(F.col("t")))] == [True, True, True, False, True]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.5,), (9.0,)], "x double").coalesce(1)
    assert values(df, ex.clip(F.col("x"), 0.0, 1.0)) == [None, 0.0, 0.5, 1.0]


def test_blank_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("\t\n",), (" a b \t",)], "t string").coalesce(1)
    assert values(df, ex.has_text(F.col("t"))) == [0, 0, 0, 0, 1]
    assert values(df, ex.text_length(F.col("t"))) == [0, 0, 0, 0, 3]


def test_map_values_and_whole_or_zero(spark):
    df = spark.createDataFrame([("SP", "3"), ("??", "x"), (None, None)], "s string, n string").coalesce(1)
    assert values(df, ex.map_values(F.col("s"), {"SP": "sudeste"}, "outro")) == ["sudeste", "outro", "outro"]
    assert values(df, ex.whole_or_zero(F.col("n").try_cast("int"))) == [3, 0, 0]


def test_dates_do_not_see_clock_changes(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([("2017-10-14 12:00:00", "2017-10-15 12:00:00")], "a string, b string")
        a, b = ex.try_timestamp(F.col("a")), ex.try_timestamp(F.col("b"))
        assert values(df, ex.days_between(a, b)) == [1.0]
        assert values(df, ex.hours_between(a, b)) == [24.0]
        # half past midnight did not exist on that day
        gap = spark.createDataFrame([("2017-10-15 00:30:00", "2017-10-15 02:00:00")], "a string, b string")
        assert values(gap, ex.hours_between(a, b)) == [1.5]
        assert values(df, ex.year_month(b)) == ["2017-10"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
