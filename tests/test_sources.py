import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orderpulse.plans import cleaning, dataset, master
from orderpulse.sources import catalog, sinks, staging


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "translation.csv").write_text(
        "﻿product_category_name,product_category_name_english\ncama,bed\nlivro,book\n", encoding="utf-8"
    )
    (tmp_path / "reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"two\nlines, ""quoted""",2018-01-01,2018-01-02 10:00:00\n'
        "r2,o2,x,t,,not a date,2018-02-30 00:00:00\n"
    )
    return tmp_path


def test_csv_catalog_with_declared_types(spark, folder):
    found = catalog.load_catalog(spark, str(folder), required=False, views=True)
    assert set(found) == {"translation", "reviews"}
    assert found["translation"].columns == ["product_category_name", "product_category_name_english"]
    rows = {r.review_id: r for r in found["reviews"].collect()}
    assert rows["r1"].review_comment_message == 'two\nlines, "quoted"' and rows["r1"].review_comment_title is None
    assert rows["r2"].review_score is None and rows["r2"].review_answer_timestamp is None
    assert rows["r1"].review_answer_timestamp.hour == 10
    assert dict(found["reviews"].dtypes)["review_score"] == "int"
    assert spark.sql("SELECT count(*) FROM translation").first()[0] == 2


def test_missing_tables_raise_when_required(spark, folder):
    with pytest.raises(AnalysisException):
        catalog.load_catalog(spark, str(folder))
    assert catalog.read_table(spark, f"{folder}/orders.csv", required=False) is None


def test_other_file_names_and_formats(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t_v2")
    found = catalog.load_catalog(spark, str(tmp_path), ["t"], fmt="parquet", files={"t": "t_v2"})
    assert found["t"].count() == 3


def test_csv_sink_round_trips_text(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c\nd'), (2, None)], "k int, t string")
    sinks.write_table(df, f"{tmp_path}/t.csv", "csv")
    back = catalog.read_csv(spark, f"{tmp_path}/t.csv", "k int, t string", multiline=True)
    assert sorted(back.collect()) == sorted(df.collect())


def test_splits_are_pruned_and_verified(spark, tmp_path):
    df = spark.range(10).selectExpr("id AS order_id", "1 AS satisfecho", "if(id < 4, 'train', 'val') AS split")
    sinks.write_splits(df, f"{tmp_path}/s")
    part = sinks.read_split(spark, f"{tmp_path}/s", "train")
    assert part.count() == 4 and "split" not in part.columns
    written = spark.read.parquet(f"{tmp_path}/s")
    plan = written.where("split = 'val'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert {r.ok for r in sinks.verify_written(written, df).collect()} == {True}
    gone = sinks.verify_written(written.where("split = 'val'"), df).collect()
    assert {r.split: r.ok for r in gone} == {"train": False, "val": True}
    x, y = sinks.features_and_label(df)
    assert x.columns == ["order_id", "split"] and y.columns == ["order_id", "satisfecho"]


def test_history_starts_empty(spark, tmp_path):
    assert sinks.read_history(spark, f"{tmp_path}/none").count() == 0


def test_staged_tables_live_in_the_shared_folder(spark):
    out = staging.stage(spark.range(5).select("id", F.lit("x").alias("s")), "t")
    assert out.count() == 5
    assert all(staging.shared_folder(spark) in f for f in out.inputFiles())


def test_reports_are_written_as_json(spark, tmp_path):
    sinks.write_report(spark.createDataFrame([("t", 3)], "tabla string, filas int"), f"{tmp_path}/r")
    assert spark.read.json(f"{tmp_path}/r").first().filas == 3


def test_raw_csv_files_run_through_to_model_features(spark, tmp_path):
    """The whole preparation from CSV files with string keys."""
    months = ["2017-05", "2017-09", "2018-02", "2018-05", "2018-08"]
    orders, items, payments, reviews = [], [], [], []
    for i in range(60):
        d = f"{months[i % 5]}-{10 + i % 15}"
        late = i % 4 == 0
        orders.append(f"o{i},c{i % 7},delivered,{d} 10:00:00,{d} 12:00:00,{d} 20:00:00,{d[:8]}{25 + late} 00:00:00,{d[:8]}25 12:00:00")
        items += [f"o{i},{k},p{(i + k) % 3},s{(i * k) % 4},{d} 00:00:00,{10 + i % 9 + k},{1 + i % 3}" for k in range(1, 2 + i % 2)]
        payments.append(f"o{i},1,{'boleto' if i % 3 else 'credit_card'},{1 + i % 3},{12 + i}")
        reviews.append(f"r{i},o{i},{2 if late else 5},,{'late' if late else ''},{d},{d} 23:00:00")
    files = {
        "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n" + "\n".join(orders),
        "items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n" + "\n".join(items),
        "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n" + "\n".join(payments),
        "reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n" + "\n".join(reviews),
        "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n" + "\n".join(f"c{i},u{i},0100{i},x,{'SP' if i % 2 else 'AL'}" for i in range(7)),
        "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n" + "\n".join(f"p{i},cat{i},{5 + i},{50 + i},{i},{100 * i + 1},{1 + i},2,3" for i in range(3)),
        "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + "\n".join(f"s{i},1000,y,{'SP' if i % 2 else 'RJ'}" for i in range(4)),
        "translation": "product_category_name,product_category_name_english\ncat0,zero\ncat1,one\ncat2,two",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text + "\n")
    tables = catalog.load_catalog(spark, str(tmp_path), {n: catalog.RAW_TABLES[n] for n in files})
    assert tables["customers"].first().customer_zip_code_prefix.startswith("0")
    table = master.master_table(tables)
    assert table.count() == 60 and len(table.columns) == 65
    done = cleaning.clean_master(table)
    assert len(done.table.columns) == 49
    data = dataset.model_dataset(done.table)
    assert len(data.features) == 41 and "te_product_category_name_english" in data.features
    sizes = {r["split"]: r["count"] for r in data.table.groupBy("split").count().collect()}
    assert sizes == {"train": 24, "val": 12, "backtest": 12, "live": 12}
    train = data.part("train").agg(F.avg("total_price"), F.stddev_pop("total_price")).first()
    assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1)
