"""Cleaned and model-ready tables, and the queries that fit learners.

SQL cannot fit a learner.  Their queries return what it can derive as well
(rows, positives and target rate as scored) and facts that must hold of the
fitted model; the metrics themselves are columns of the operators.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from orderpulse.operators import features as ft, learners as ln, metrics as mt, selection as sel
from orderpulse.plans import monitoring, stepwise, training
from orderpulse.registry import Registry, frames, r, roles_sql as R, rounded
from orderpulse.sources import star
from orderpulse.sources.staging import shared_folder, stage
from orderpulse.streaming import batches

Q = Registry()

DIGITS = 7
CATEGORIES = ("customer_state", "seller_state", "payment_type", "customer_region", "product_category_name_english")
# The cleaned table's number columns, in the order in which they are made.
CLEAN_NUMBERS = (
    "actual_delivery_days", "delivery_delay_days", "delivered_on_time", "promised_delivery_days",
    "approval_time_hours", "dispatch_time_hours", "delay_ratio", "purchase_month", "purchase_dayofweek",
    "purchase_hour", "order_item_count", "total_price", "total_freight_value", "avg_price_per_item",
    "max_price_item", "min_price_item", "unique_sellers", "freight_ratio", "payment_value", "payment_installments",
    "payment_types_count", "total_order_value", "is_multi_seller", "is_multi_item", "log_payment_value",
    "log_freight_value", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    "product_photos_qty", "product_description_lenght", "product_name_lenght", "product_volume_cm3",
    "has_product_photo", "customer_high_risk_state", "seller_customer_same_state", "interaccion_retraso_items",
    "interaccion_precio_tarde", "interaccion_entrega_flete",
)


def _clip(c: str) -> str:
    if c in ft.WINSOR_COLUMNS:
        return f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, lo_{c}), hi_{c}) END::DOUBLE AS {c}"
    return f"{c}::DOUBLE AS {c}"


_BOUNDED = [c for c in ft.WINSOR_COLUMNS if c in CLEAN_NUMBERS]
CLEAN_SQL = R.MASTER + f""",
bounds AS (SELECT {', '.join(f'quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}' for c in _BOUNDED)} FROM master),
clipped AS (SELECT order_id, order_status, order_purchase_timestamp, satisfecho, {', '.join(CATEGORIES)},
  {', '.join(map(_clip, CLEAN_NUMBERS))} FROM master, bounds),
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in CLEAN_NUMBERS)} FROM clipped),
filled AS (SELECT order_id, order_status, order_purchase_timestamp, satisfecho,
  {', '.join(f"coalesce({c}, 'desconocido') AS {c}" for c in CATEGORIES)},
  {', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in CLEAN_NUMBERS)} FROM clipped, med),
clean AS (SELECT * REPLACE ({', '.join(
    f"CASE WHEN (count(*) OVER (PARTITION BY {c})) / (count(*) OVER ())::DOUBLE < 0.01 THEN 'otros' ELSE {c} END AS {c}"
    for c in CATEGORIES)}) FROM filled)"""


@Q.query("clean_master", R.sql(CLEAN_SQL, f"""SELECT order_id, order_status, satisfecho, {', '.join(CATEGORIES)},
    {', '.join(r(c, c, DIGITS) for c in CLEAN_NUMBERS)},
    strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS purchased FROM clean"""))
def clean_master(spark, folder):
    table = frames.cleaned(spark, folder).table
    extra = set(table.columns) - {*CLEAN_NUMBERS, *CATEGORIES}
    assert extra == {"order_id", "order_status", "satisfecho", "order_purchase_timestamp"}, extra
    out = table.withColumns({c: F.col(c).cast("double") for c in CLEAN_NUMBERS}).withColumn(
        "purchased", F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")
    )
    return rounded(out.drop("order_purchase_timestamp"), DIGITS)


FEATURES = (*CLEAN_NUMBERS, "te_product_category_name_english")
DATASET_SQL = CLEAN_SQL + f""",
parts AS (SELECT *, CASE WHEN order_purchase_timestamp <= TIMESTAMP '{star.CUTOFFS[0]}' THEN 'train'
    WHEN order_purchase_timestamp <= TIMESTAMP '{star.CUTOFFS[1]}' THEN 'val'
    WHEN order_purchase_timestamp <= TIMESTAMP '{star.CUTOFFS[2]}' THEN 'backtest' ELSE 'live' END AS split FROM clean),
te AS (SELECT product_category_name_english, avg(satisfecho) AS m FROM parts WHERE split = 'train' GROUP BY 1),
encoded AS (SELECT p.*, coalesce(m, (SELECT avg(satisfecho) FROM parts WHERE split = 'train')) AS te_product_category_name_english
  FROM parts p LEFT JOIN te USING (product_category_name_english)),
fitted AS (SELECT {', '.join(f'avg({c}) AS a_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}' for c in FEATURES)}
  FROM encoded WHERE split = 'train')"""


@Q.query("model_dataset", R.sql(DATASET_SQL, f"""SELECT order_id, split, satisfecho,
    {', '.join(r(f'({c} - a_{c}) / s_{c}', c, 5) for c in FEATURES)} FROM encoded, fitted"""))
def model_dataset(spark, folder):
    data = frames.model_data(spark, folder)
    assert set(data.features) == set(FEATURES), set(data.features) ^ set(FEATURES)
    return rounded(data.table, 5)


PARTS = DATASET_SQL
FITTED_ON = "split IN ('train', 'val', 'backtest')"
#: Largest entry of the mean loss's gradient that counts as an optimum.
STATIONARY = 2e-3


def _between(column: str):
    return F.col(column).between(0.0, 1.0)


def _facts(metrics, by):
    """What SQL can derive too of a table of metrics, and whether the rest of each row is consistent."""
    valid = (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp") == F.col("n")) & (F.col("support_0") + F.col("support_1") == F.col("n"))
    for c in ("auc", "avg_prec", "brier", "accuracy", "f1_0", "f1_1"):
        valid = valid & _between(c)
    return rounded(metrics.select(
        *by, "n", F.col("support_1").alias("positives"), "target_rate", F.coalesce(valid, F.lit(False)).alias("valid")
    ))


def _facts_sql(names: str = "", where: str = FITTED_ON) -> str:
    return f"""SELECT {names} split, count(*) AS n, sum(satisfecho)::BIGINT AS positives, {r('avg(satisfecho)', 'target_rate')},
      true AS valid FROM parts WHERE {where} GROUP BY ALL"""


def _fitted(spark, folder, spec):
    data = frames.model_data(spark, folder)
    return data, ln.fit(spec, data.part("train"), data.features, data.label, data.key)


def _scored(data, model):
    """Scores are written once; then every metric of a split, and whether all probabilities are such."""
    rows = data.part("train", "val", "backtest")
    scored = stage(
        model.score(rows.select(data.key, "split", F.col(data.label).alias("label"), *model.features)).select(
            "split", "label", "proba"
        ), "scores",
    )
    facts = _facts(mt.all_metrics(scored, ["split"]), ["split"])
    range_ = scored.groupBy("split").agg(F.bool_and(F.coalesce(_between("proba"), F.lit(False))).alias("_in"))
    return facts.join(range_, "split").withColumn("valid", F.col("valid") & F.col("_in")).drop("_in")


@Q.query("logistic_model", R.sql(PARTS, f"SELECT *, true AS optimal FROM ({_facts_sql()})"))
def logistic_model(spark, folder):
    """Rows and positives as scored; the gradient vanishes at the fitted weights."""
    spec = ln.Spec(ln.LOGISTIC, {"C": 1.0, "class_weight": "balanced"})
    data, model = _fitted(spark, folder, spec)
    steepest = max(map(abs, ln.logistic_gradient(model, spec, data.part("train"), data.label).values()))
    return _scored(data, model).withColumn("optimal", F.lit(steepest < STATIONARY))


@Q.query("elastic_net_model", R.sql(PARTS, f"SELECT *, true AS sparse FROM ({_facts_sql()})"))
def elastic_net_model(spark, folder):
    """Half of the penalty on absolute weights, strong enough that some of them vanish."""
    data, model = _fitted(spark, folder, ln.Spec(ln.LOGISTIC, {"C": 0.01, "l1_ratio": 0.5, "class_weight": "balanced"}))
    weights, _ = model.linear_weights()
    return _scored(data, model).withColumn("sparse", F.lit(0.0 in weights.values()))


@Q.query("forest_model", R.sql(PARTS, _facts_sql()))
def forest_model(spark, folder):
    return _scored(*_fitted(spark, folder, stepwise.JUDGE))


@Q.query("boosting_model", R.sql(PARTS, _facts_sql()))
def boosting_model(spark, folder):
    return _scored(*_fitted(spark, folder, training.BASELINES["Gradient Boosting"]))


@Q.query("calibrated_svm", R.sql(PARTS, _facts_sql()))
def calibrated_svm(spark, folder):
    return _scored(*_fitted(spark, folder, training.BASELINES["linearSVM"]))


@Q.query("isotonic_svm", R.sql(PARTS, _facts_sql()))
def isotonic_svm(spark, folder):
    return _scored(*_fitted(spark, folder, ln.Spec(ln.SVM, {"C": 1.0, "calibration_method": "isotonic"})))


# One row per feature, with the number of its distinct values on the training rows.
_DISTINCT = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, count(DISTINCT {f}) AS found FROM encoded WHERE split = 'train'" for f in FEATURES
)


@Q.query("rf_importance", R.sql(PARTS, f"""SELECT feature, true AS valid, 1.0::DOUBLE AS total FROM ({_DISTINCT})"""))
def rf_importance(spark, folder):
    """Importances lie between 0 and 1, add up to 1, and a constant feature has none."""
    data, model = _fitted(spark, folder, stepwise.JUDGE)
    found = model.importances()
    varied = set(sel.nonconstant(data.part("train"), data.features))
    rows = [(f, 0 <= v <= 1 and (f in varied or v == 0), round(sum(found.values()), 6)) for f, v in found.items()]
    return spark.createDataFrame(rows, "feature string, valid boolean, total double")


_CANDIDATES = ((1, 2), (2, 1), (3, 4), (4, 3), (5, 1), (6, 3))


@Q.query("stepwise_selection", "SELECT * FROM (VALUES (0, 'Estado_Inicial', 1, true), " + ", ".join(
    f"({step}, '{stepwise.STEPS[step - 1]}', {n}, true)" for step, n in _CANDIDATES
) + ") AS t(paso, metodo, candidatos, valid)")
def stepwise_selection(spark, folder):
    """Candidates per step; each keeps and drops the same features in all, and at most one of them wins."""
    steps = stepwise.select_features(frames.model_data(spark, folder)).steps
    split = F.col("n_features") + F.col("n_eliminadas")
    valid = (F.count_if("elegido") <= 1) & (F.min(split) == F.max(split))
    return steps.groupBy("paso", "metodo").agg(F.count("*").cast("int").alias("candidatos"), valid.alias("valid"))


@Q.query("univariate_forest", R.sql(PARTS, f"SELECT feature, found > 1 AS varied, true AS valid FROM ({_DISTINCT})"))
def univariate_forest(spark, folder):
    """A forest per feature: an AUC for each that varies, none for a constant one."""
    data = frames.model_data(spark, folder)
    found = stepwise.forest_aucs(data, data.features, ("train", "val"))
    rows = [(f, v is not None, v is None or 0 <= v <= 1) for f, v in found.items()]
    return spark.createDataFrame(rows, "feature string, varied boolean, valid boolean")


@Q.query("baseline_models", R.sql(PARTS, "SELECT m.model, f.*, true AS listed FROM (" + _facts_sql(where="split IN ('train', 'val')")
    + ") f, (VALUES " + ", ".join(f"('{m}')" for m in training.BASELINES) + ") AS m(model)"))
def baseline_models(spark, folder):
    """All baselines; each has a rank, an overfit flag and a threshold on the grid."""
    out = training.train_baselines(frames.model_data(spark, folder))
    listed = out.leaderboard.join(out.overfit, "model").join(out.thresholds.select("model", "threshold"), "model").select(
        "model", (F.col("rank").between(1, len(training.BASELINES)) & F.col("overfit").isNotNull() & _between("threshold")).alias("listed")
    )
    return _facts(out.metrics, ["model", "split"]).join(listed, "model")


def _tuned_sql(names) -> str:
    models = ", ".join(f"('{m}', {'NULL' if m == 'Stacking' else 5}::BIGINT)" for m in (*names, "Stacking"))
    return R.sql(PARTS, f"""SELECT m.model, f.*, m.folds FROM ({_facts_sql(where="split IN ('val', 'backtest')")}) f,
      (VALUES {models}) AS m(model, folds)""")


#: Learners of the round, with the full number of draws; a draw of boosting is up to 500 rounds of its own and no query.
DRAWS = {"Logistic Regression": training.TRIALS, "LinearSVC": training.TRIALS}


def _tuned(spark, folder, pos_label):
    """A round of the search for one class: all draws, five folds, refit and stacking."""
    spaces = {name: training.SPACES[name] for name in DRAWS}
    tuned = training.tune(frames.model_data(spark, folder), spaces, trials=DRAWS, pos_label=pos_label)
    stacked = tuned.stacked.withColumn("model", F.lit("Stacking"))
    facts = _facts(tuned.metrics.unionByName(stacked, allowMissingColumns=True), ["model", "split"])
    return facts.join(tuned.cv.select("model", "folds"), "model", "left")


@Q.query("tuned_models", _tuned_sql(DRAWS))
def tuned_models(spark, folder):
    return _tuned(spark, folder, 0)


@Q.query("tuned_models_class_1", _tuned_sql(DRAWS))
def tuned_models_class_1(spark, folder):
    return _tuned(spark, folder, 1)


@Q.query("search_history")
def search_history(spark, folder):
    """Every draw of the linear learners for both classes: settings, F1 on the validation rows, best so far."""
    spaces = {name: training.SPACES[name] for name in ("Logistic Regression", "LinearSVC")}
    runs = training.search_rounds(frames.model_data(spark, folder), spaces)
    return training.search_table(spark, runs)


@Q.query("batch_report_trend", R.sql(PARTS, """SELECT '2026-01-01 00:00:00' AS "timestamp", 1 AS run, count(*) AS n_registros, true AS valid
    FROM parts WHERE split = 'backtest'
    UNION ALL SELECT '2026-02-01 00:00:00', 2, count(*), true FROM parts WHERE split = 'live'"""))
def batch_report_trend(spark, folder):
    """Score two periods with one model, append both to the history, and read its trend."""
    data, model = _fitted(spark, folder, ln.Spec(ln.LOGISTIC, {"class_weight": "balanced"}))
    history = f"{shared_folder(spark)}/history-{uuid.uuid4().hex}"
    monitoring.batch_report(data.part("backtest"), model, history, timestamp="2026-01-01 00:00:00")
    trend = monitoring.batch_report(data.part("live"), model, history, timestamp="2026-02-01 00:00:00")["trend"]
    valid = _between("auc_roc") & _between("accuracy") & _between("f1_clase_0")
    return trend.select("timestamp", "run", "n_registros", valid.alias("valid"))


@Q.query("streamed_batches", R.sql(PARTS, "SELECT count(*) AS n, true AS valid FROM parts WHERE split IN ('backtest', 'live')"))
def streamed_batches(spark, folder):
    """Score the model table as arriving files: every row is scored in one batch or another."""
    data, model = _fitted(spark, folder, ln.Spec(ln.LOGISTIC, {"class_weight": "balanced"}))
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    data.part("backtest", "live").write.parquet(f"{base}/in")
    schema = T.StructType(data.table.schema.fields)
    batches.score_new_batches(
        spark, f"{base}/in", schema, model, f"{base}/out", f"{base}/checkpoint", data.label, data.key
    ).awaitTermination()
    valid = F.bool_and(_between("auc") & _between("accuracy") & _between("f1_0"))
    return batches.batch_history(spark, f"{base}/out").agg(F.sum("n").alias("n"), valid.alias("valid"))


@Q.query("coefficient_table", R.sql(PARTS, f"SELECT feature, true AS stationary FROM ({_DISTINCT})"))
def coefficient_table(spark, folder):
    """Every feature's weight, at which the loss has no slope."""
    spec = ln.Spec(ln.LOGISTIC, {"C": 1.0})
    data, model = _fitted(spark, folder, spec)
    slopes = ln.logistic_gradient(model, spec, data.part("train"), data.label)
    flat = F.create_map(*[F.lit(x) for f, g in slopes.items() for x in (f, abs(g) < STATIONARY)])
    return monitoring.coefficient_table(model, spark).select("feature", F.element_at(flat, F.col("feature")).alias("stationary"))


@Q.query("logistic_coefficients")
def logistic_coefficients(spark, folder):
    """Each feature's weight in the logistic model, and the intercept."""
    data, model = _fitted(spark, folder, ln.Spec(ln.LOGISTIC, {"C": 1.0}))
    weights, intercept = model.linear_weights()
    rows = [*weights.items(), ("(intercept)", intercept)]
    return spark.createDataFrame(rows, "feature string, coefficient double")


@Q.query("forest_importances")
def forest_importances(spark, folder):
    """Each feature's importance in the judging forest, most important first."""
    data, model = _fitted(spark, folder, stepwise.JUDGE)
    ranked = sorted(model.importances().items(), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(i, f, v) for i, (f, v) in enumerate(ranked, 1)], "rank int, feature string, importance double")


@Q.query("selection_table")
def selection_table(spark, folder):
    """The selection as it went: metrics of every candidate of every step, what it removed, which one won."""
    return stepwise.select_features(frames.model_data(spark, folder)).steps


@Q.query("univariate_forest_aucs")
def univariate_forest_aucs(spark, folder):
    """Validation AUC of each feature's own forest, best first; missing for a constant feature."""
    data = frames.model_data(spark, folder)
    found = stepwise.forest_aucs(data, data.features, ("train", "val"))
    ranked = sorted(found.items(), key=lambda x: (-(x[1] or 0.0), x[0]))
    return spark.createDataFrame([(f, v) for f, v in ranked], "feature string, auc double")
