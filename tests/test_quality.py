import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderpulse.operators import quality as qa
from orderpulse.plans import cleaning


def test_profile_counts_rows_cells_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None)], "x int, y string")
    row = qa.table_profile(df, "t").first()
    assert (row.filas, row.columnas, row.nulos_total, row.columnas_con_nulos, row.duplicados) == (5, 2, 3, 2, 2)
    empty = qa.table_profile(df.where("false"), "e").first()
    assert (empty.filas, empty.nulos_total, empty.duplicados) == (0, 0, 0)


def test_alerts_and_summary(spark):
    clean = spark.createDataFrame([(1,), (2,)], "x int")
    dirty = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    profiles = qa.profile_all({"clean": clean, "dirty": dirty})
    alerts = {r.tabla: (r.estado, r.alertas) for r in qa.quality_alerts(profiles).collect()}
    assert alerts == {"clean": ("OK", ""), "dirty": ("REVISAR", "1 duplicados | 1 nulos")}
    total = qa.profile_summary(profiles, expected=3).first()
    assert (total.tablas_limpias, total.total_filas, total.estado_general) == (1, 5, "INCOMPLETO")


def test_missing_share_is_strict(spark):
    rows = [(None if i < 15 else i, None if i < 16 else i) for i in range(100)]
    df = spark.createDataFrame(rows, "at15 int, at16 int")
    assert qa.drop_sparse(df, 0.15).columns == ["at15"]
    report = {r.column: (r.missing, r.pct) for r in qa.missing_report(df).collect()}
    assert report == {"at15": (15, 15.0), "at16": (16, 16.0)}


def test_drop_listed_logs_absent_names(spark):
    df = spark.range(1).selectExpr("id AS keep", "id AS customer_id", "id AS has_comment")
    kept, log = qa.drop_listed(df)
    assert kept.columns == ["keep"]
    assert {r.column_name for r in log.where("dropped = 1").collect()} == {"customer_id", "has_comment"}
    assert log.count() == 17


def test_impute_median_and_constant(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (None, "b", 3.0), (4, "b", 4.0)], "n int, s string, full double")
    fills = qa.fit_imputation(df)
    assert set(fills) == {"n", "s"}
    assert fills["n"]["valor"] == 2.0 and fills["s"]["valor"] == "desconocido"
    out = qa.apply_imputation(df, fills)
    assert out.where("n IS NULL OR s IS NULL").count() == 0
    log = {r.column: (r.tipo, r.valor, r.nulos_imputados) for r in qa.imputation_log(df, fills).collect()}
    assert log == {"n": ("mediana", "2.0000", 1), "s": ("constante", "desconocido", 1)}


def test_repair_drops_undated_rows_and_uses_the_smallest_mode(spark):
    t = dt.datetime(2018, 1, 1)
    df = spark.createDataFrame(
        [(t, "b", 1.0, None), (t, "a", 3.0, None), (t, "b", None, None), (t, "a", 5.0, None), (t, None, 7.0, None), (None, "z", 99.0, None)],
        "ts timestamp_ntz, s string, n double, nothing string",
    )
    out = qa.repair(df, "ts")
    assert out.count() == 5
    assert out.where("s = 'a'").count() == 3
    assert sorted(r.n for r in out.collect()) == [1.0, 3.0, 4.0, 5.0, 7.0]
    assert {r.nothing for r in out.collect()} == {"Unknown"}


def test_rare_categories_are_strictly_below_the_share(spark):
    rows = [("one",)] * 1 + [("few",)] * 2 + [("many",)] * 97 + [(None,)] * 3
    df = spark.createDataFrame(rows, "c string")
    counts = lambda t: {r.c: r["count"] for r in qa.bucket_rare(df, ["c", "absent"], t).groupBy("c").count().collect()}
    assert counts(0.01) == {"one": 1, "few": 2, "many": 97, None: 3}
    assert counts(0.011) == {"otros": 1, "few": 2, "many": 97, None: 3}
    log = qa.rare_log(df, ["c"], 0.021).first()
    assert (log.categorias_agrupadas, log.cardinalidad_final) == (2, 2)


def test_fill_text_can_itself_become_rare(spark):
    df = spark.createDataFrame([(i, "x" if i else None, 1, "d") for i in range(200)], "order_id int, payment_type string, satisfecho int, order_status string")
    done = cleaning.clean_master(df)
    assert {r.payment_type for r in done.table.collect()} == {"x", "otros"}
    assert done.rare.first().column == "payment_type" and done.sparse == {}


def test_invariants_name_the_failing_columns(spark):
    good = spark.createDataFrame([(1, 0), (2, 1)], "x int, satisfecho int")
    assert qa.require_invariants(good) is good
    bad = spark.createDataFrame([(None, 0, 5), (2, 3, 5)], "x int, satisfecho int, review_score int")
    found = {r.check: r.violations for r in qa.invariants(bad).collect()}
    assert found == {"missing_cells": 1, "label_domain": 1, "leakage_columns": 1}
    with pytest.raises(ValueError, match=r"\['x'\]"):
        qa.require_invariants(bad)


def test_duplicate_count_treats_missing_as_equal(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0), (2, 1.0)], "a int, b double")
    row = qa.duplicate_count(df).first()
    assert (row.n_rows, row.duplicates) == (3, 1)


def test_schema_listing_and_first_rows(spark):
    df = spark.range(5).select("id", F.lit("x").alias("s"))
    rows = qa.schema_listing({"t": df}).collect()
    assert [tuple(r) for r in rows] == [("t", 1, "id", "bigint", 0), ("t", 2, "s", "string", 0)]
    assert [r.id for r in qa.first_rows(df.orderBy(F.desc("id")), ["id"]).collect()] == [0, 1]


def test_stage_report_is_long_form(spark):
    df = spark.createDataFrame([(1, 1), (None, 0), (3, 1)], "x int, satisfecho int")
    rows = {(r.column, r.metric): r.value for r in qa.stage_report(df, "s", "t", "satisfecho").collect()}
    assert rows == {
        (None, "rows"): 3.0, (None, "columns"): 2.0, ("x", "missing"): 1.0, ("satisfecho", "positive"): 2.0,
        ("satisfecho", "negative"): 1.0, ("satisfecho", "rate"): pytest.approx(2 / 3),
    }
