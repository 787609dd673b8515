import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from orderpulse.operators import features as ft
from orderpulse.plans import master

D = dt.datetime
B = D(2018, 3, 5, 14, 30)


def day(n):
    return B + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    orders = [
        ("o1", "c1", "delivered", B, B + dt.timedelta(hours=2), day(1), day(8), day(10)),
        ("o2", "c2", "delivered", B, B, day(1), day(12), day(10)),
        ("o3", "c3", "delivered", B, None, None, None, day(10)),
        ("o4", "c1", "canceled", B, B, None, None, day(10)),
        ("o5", "c1", "delivered", B, B, day(1), day(2), B),
        ("o6", "c9", "delivered", B, B, day(1), day(2), day(3)),
    ]
    items = [
        ("o1", 1, "p1", "s1", 10.0, 2.0), ("o1", 2, "p2", "s2", 30.0, 3.0),
        ("o2", 1, "p1", "s1", 0.0, 0.0),
        ("o3", 2, "p2", "s2", 5.0, 1.0), ("o3", 1, "p1", "s1", 5.0, 1.0),
        ("o6", 1, "p3", "s9", None, 1.0),
    ]
    payments = [
        ("o1", 1, "boleto", 1, 20.0), ("o1", 2, "credit_card", 3, 25.0),
        ("o2", 1, "voucher", 1, None),
        ("o3", 2, "debit", 1, 6.0), ("o3", 1, "boleto", 2, 6.0),
    ]
    reviews = [
        ("r1", "o1", 2, "old", "bad", day(9)), ("r2", "o1", 5, None, "  good\t", day(11)),
        ("r3", "o2", 3, "", " \n", day(13)), ("r4", "o3", 4, "t", None, None),
        ("r5", "o5", 1, None, None, day(3)), ("r6", "o6", None, None, None, day(3)),
        ("r7", "o4", 5, None, None, day(3)),
    ]
    return {
        "orders": make(
            orders,
            """order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz,
            order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz,
            order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz""",
        ),
        "items": make(
            items, "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"
        ),
        "payments": make(
            payments,
            "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
        ),
        "reviews": make(
            reviews,
            """review_id string, order_id string, review_score int, review_comment_title string,
            review_comment_message string, review_answer_timestamp timestamp_ntz""",
        ),
        "customers": make(
            [("c1", "1000", "sao paulo", "SP"), ("c2", "2000", "maceio", "AL"), ("c3", "3000", "x", None)],
            "customer_id string, customer_zip_code_prefix string, customer_city string, customer_state string",
        ),
        "sellers": make(
            [("s1", "curitiba", "PR"), ("s2", "sao paulo", "SP")], "seller_id string, seller_city string, seller_state string"
        ),
        "products": make(
            [("p1", "cama", 1.0, 2.0, 0.0, 100.0, 2.0, 3.0, 4.0), ("p2", "livro", 1.0, 2.0, None, 50.0, 1.0, None, 1.0)],
            """product_id string, product_category_name string, product_name_lenght double,
            product_description_lenght double, product_photos_qty double, product_weight_g double,
            product_length_cm double, product_height_cm double, product_width_cm double""",
        ),
        "translation": make([("cama", "bed")], "product_category_name string, product_category_name_english string"),
    }


@pytest.fixture(scope="module")
def rows(tables):
    return {r.order_id: r for r in master.order_features(tables, keep_score=True).collect()}


def test_population_is_delivered_orders_with_a_numeric_score(rows):
    assert set(rows) == {"o1", "o2", "o3", "o5"}


def test_latest_review_wins(rows):
    assert rows["o1"].review_score == 5 and rows["o1"].satisfecho == 1
    assert rows["o2"].satisfecho == 0


def test_time_features(rows):
    r = rows["o1"]
    assert (r.actual_delivery_days, r.delivery_delay_days, r.promised_delivery_days) == (8.0, -2.0, 10.0)
    assert (r.approval_time_hours, r.dispatch_time_hours, r.delay_ratio) == (2.0, 22.0, -0.2)
    assert (r.purchase_month, r.purchase_dayofweek, r.purchase_hour, r.purchase_year_month) == (3, 0, 14, "2018-03")
    assert (rows["o1"].delivered_on_time, rows["o2"].delivered_on_time, rows["o3"].delivered_on_time) == (1, 0, 0)
    assert rows["o3"].actual_delivery_days is None
    assert rows["o5"].delay_ratio is None  # promised in zero days


def test_value_features(rows):
    r = rows["o1"]
    assert (r.order_item_count, r.total_price, r.total_freight_value, r.avg_price_per_item) == (2, 40.0, 5.0, 20.0)
    assert (r.max_price_item, r.min_price_item, r.unique_sellers) == (30.0, 10.0, 2)
    assert r.freight_ratio == pytest.approx(5 / 45) and r.total_order_value == 45.0
    assert (r.payment_value, r.payment_installments, r.payment_types_count, r.payment_type) == (45.0, 3, 2, "credit_card")
    assert rows["o2"].freight_ratio is None  # nothing paid at all
    assert rows["o2"].payment_value == 0.0  # a sum over missing values only
    assert rows["o5"].total_price is None and rows["o5"].payment_value is None  # no child rows


def test_ties_follow_the_item_and_payment_numbers(rows):
    assert (rows["o3"].seller_id, rows["o3"].product_id) == ("s1", "p1")
    assert rows["o3"].payment_type == "boleto"


def test_unpriced_main_item_still_has_a_seller(spark, tables):
    got = ft.summarize_items(tables["items"]).where("order_id = 'o6'").first()
    assert (got.seller_id, got.total_price, got.avg_price_per_item, got.max_price_item) == ("s9", 0.0, None, None)


def test_complexity_features(rows):
    assert (rows["o1"].is_multi_seller, rows["o1"].is_multi_item, rows["o1"].uses_installments) == (1, 1, 1)
    assert (rows["o5"].is_multi_seller, rows["o5"].is_multi_item, rows["o5"].uses_installments) == (0, 0, 0)
    assert rows["o1"].log_payment_value == pytest.approx(math.log1p(45.0)) and rows["o5"].log_payment_value == 0.0


def test_product_features(rows):
    assert (rows["o2"].product_category_name_english, rows["o1"].product_category_name_english) == ("bed", None)
    assert rows["o2"].product_volume_cm3 == 24.0 and rows["o1"].product_volume_cm3 is None
    assert (rows["o1"].has_product_photo, rows["o2"].has_product_photo) == (0, 0)


def test_customer_features(rows):
    assert (rows["o1"].customer_region, rows["o2"].customer_region, rows["o3"].customer_region) == (
        "sudeste", "nordeste", "outro",
    )
    assert (rows["o1"].customer_high_risk_state, rows["o2"].customer_high_risk_state) == (0, 1)
    assert (rows["o1"].seller_customer_same_state, rows["o2"].seller_customer_same_state) == (1, 0)
    assert rows["o3"].seller_customer_same_state == 0


def test_text_features(rows):
    assert (rows["o1"].has_comment, rows["o1"].has_review_title, rows["o1"].comment_length) == (1, 0, 4)
    assert (rows["o2"].has_comment, rows["o2"].has_review_title, rows["o2"].comment_length) == (0, 0, 0)
    assert (rows["o3"].has_comment, rows["o3"].has_review_title, rows["o3"].comment_length) == (0, 1, 0)


def test_interactions_fill_items_with_one(rows):
    assert rows["o2"].interaccion_retraso_items == 2.0 and rows["o2"].interaccion_precio_tarde == 0.0
    assert rows["o5"].interaccion_retraso_items == 2.0 * 1
    assert rows["o3"].interaccion_retraso_items == 0.0
    assert rows["o1"].interaccion_entrega_flete == pytest.approx(8.0 * 5 / 45)


def test_every_region_lists_its_states():
    assert sum(map(len, ft.STATE_REGIONS.values())) == 27


def test_winsorize_clamps_and_keeps_missing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "x double")
    out = [r.x for r in ft.winsorize(df, ["x", "absent"]).collect()]
    assert out.count(None) == 1
    known = sorted(v for v in out if v is not None)
    assert known[0] == 1.0 and known[-1] == 99.0
    bounds = {"x": (1.0, 99.0)}
    assert sorted(v for v in (r.x for r in ft.clip_to(ft.winsorize(df, ["x"]), bounds).collect()) if v is not None) == known
    half = ft.winsorize(df, ["x"], fit_on=df.where("x <= 50"))
    assert half.agg(F.max("x")).first()[0] == 49.5


def test_master_table_stages_and_clips(tables):
    out = master.master_table(tables, keep_text=False)
    assert out.count() == 4 and "review_comment_message" not in out.columns
    full = master.master_table(tables)
    assert "review_comment_message" in full.columns and len(full.columns) == 65


def test_exploration_keeps_every_order_and_guards_ratios(tables):
    rows = {r.order_id: r for r in ft.add_exploratory_features(master.exploratory_master(tables)).collect()}
    assert len(rows) == 6
    assert rows["o1"].review_score == 2  # the first review by id
    assert rows["o1"].payment_type == "boleto" and rows["o1"].seller_id == "s1"
    assert rows["o2"].freight_ratio == 0.0 and rows["o2"].precio_promedio_item == 0.0
    assert (rows["o1"].dias_entrega, rows["o1"].dias_retraso, rows["o1"].es_tarde) == (8, -2, 0)
    assert rows["o3"].dias_retraso is None and rows["o3"].es_tarde == 0 and rows["o3"].delivered_on_time == 0
    assert rows["o4"].tiene_comentario == 0 and rows["o1"].tiene_comentario == 1


def test_fanout_join_keeps_every_review(tables):
    joined = tables["orders"].join(tables["reviews"], "order_id", "inner")
    assert joined.where("order_id = 'o1'").count() == 2
    assert ft.reviewed_orders(tables["orders"], tables["reviews"]).where("order_id = 'o1'").count() == 1


def test_summaries_are_shuffled_once_and_keep_the_order_of_rows(spark):
    """Against sums, distinct counts and a window apart: ties, NaN, missing prices, missing orders."""
    rows = [
        ("a", 1, 5.0, "p1", "s1"), ("a", 2, 9.0, "p2", "s2"), ("a", 3, 9.0, "p0", None), ("b", 1, None, "p1", "s1"),
        ("b", 2, 0.5, "p3", "s1"), ("c", 1, 7.0, "p1", "s1"), ("c", 2, float("nan"), "p9", "s3"), ("d", 1, None, "p4", None),
        ("e", None, 2.0, "p5", "s5"), ("e", 1, 2.0, "p6", "s6"), (None, 1, 3.0, "p1", "s1"),
    ]
    items = spark.createDataFrame(rows, "order_id string, order_item_id int, price double, product_id string, seller_id string")
    items = items.withColumn("freight_value", F.lit(1.0)).repartition(3)
    got = ft.summarize_items(items)
    sums = items.groupBy("order_id").agg(F.avg("price").alias("m"), F.count_distinct("seller_id").alias("k"))
    kept = {r["order_id"]: r for r in sums.join(ft.main_items(items), "order_id").collect()}
    found = {r["order_id"]: r for r in got.collect()}
    assert set(found) == set(kept) == set("abcde")
    for key, r in found.items():
        k = kept[key]
        assert (r["unique_sellers"], r["seller_id"], r["product_id"]) == (k["k"], k["seller_id"], k["product_id"])
        assert str(r["avg_price_per_item"]) == str(k["m"])
    paid = items.select(
        "order_id", F.col("order_item_id").alias("payment_sequential"), F.col("seller_id").alias("payment_type"),
        F.col("price").alias("payment_value"), F.col("order_item_id").alias("payment_installments"),
    )
    got_paid = ft.summarize_payments(paid)
    types = {r["order_id"]: r["payment_type"] for r in ft.main_payments(paid).where("order_id IS NOT NULL").collect()}
    assert {r["order_id"]: r["payment_type"] for r in got_paid.collect()} == types
    for df in (ft.summarize_items(items), ft.summarize_payments(paid)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan


def test_dropped_columns_are_not_written(spark, monkeypatch):
    from orderpulse.operators import quality as qa
    from orderpulse.registry import frames

    written, stage = [], frames.stage
    monkeypatch.setattr(frames, "stage", lambda df, name: written.append(set(df.columns)) or stage(df, name))
    out = frames.cleaned(spark, "/root/testdata/sf0.001")
    listed = {c for columns in qa.DROP_GROUPS.values() for c in columns}
    assert written and not any(columns & listed for columns in written)
    assert {r["column_name"] for r in out.dropped.where("dropped = 1").collect()} == listed - {"review_score"}
