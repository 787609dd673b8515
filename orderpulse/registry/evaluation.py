"""Score evaluation, drift, scoring and attribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators import aggregates as ag, drift, explain, metrics as mt, preparation as pr
from orderpulse.registry import Registry, r, roles_sql as R, rounded
from orderpulse.registry.preparation import LABELLED_SQL, labelled
from orderpulse.sources import sinks, star

Q = Registry()

BY = ["period"]
CELLS = """count(*) FILTER (WHERE label = 0 AND proba < 0.5) AS tn, count(*) FILTER (WHERE label = 0 AND proba >= 0.5) AS fp,
    count(*) FILTER (WHERE label = 1 AND proba < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND proba >= 0.5) AS tp"""


def _div(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif(({b})::DOUBLE, 0), 0)"


CLASS = {
    "prec_0": _div("tn", "tn + fn"), "recall_0": _div("tn", "tn + fp"), "f1_0": _div("2 * tn", "2 * tn + fn + fp"),
    "prec_1": _div("tp", "tp + fp"), "recall_1": _div("tp", "tp + fn"), "f1_1": _div("2 * tp", "2 * tp + fn + fp"),
    "f1_macro": f"({_div('2 * tn', '2 * tn + fn + fp')} + {_div('2 * tp', '2 * tp + fn + fp')}) / 2",
    "accuracy": _div("tn + tp", "tn + fp + fn + tp"),
}
IMBALANCE = {
    "mcc": _div("tp::DOUBLE * tn - fp::DOUBLE * fn", "sqrt((tp + fp)::DOUBLE * (tp + fn)) * sqrt((tn + fp)::DOUBLE * (tn + fn))"),
    "kappa": """coalesce(((tn + tp)::DOUBLE / nullif(tn + fp + fn + tp, 0)
      - ((tp + fp)::DOUBLE * (tp + fn) + (tn + fn)::DOUBLE * (tn + fp)) / (tn + fp + fn + tp)::DOUBLE ** 2)
      / nullif(1 - ((tp + fp)::DOUBLE * (tp + fn) + (tn + fn)::DOUBLE * (tn + fp)) / (tn + fp + fn + tp)::DOUBLE ** 2, 0), 0)""",
    "bal_acc": f"({_div('tn', 'tn + fp')} + {_div('tp', 'tp + fn')}) / 2",
    "gmean": f"sqrt({_div('tn', 'tn + fp')} * {_div('tp', 'tp + fn')})",
}
CONF = R.SCORED + f", conf AS (SELECT period, {CELLS} FROM scored GROUP BY 1)"


def ranked_sql(source: str, keys: str) -> str:
    """AUC and average precision per group, from ranks and distinct scores."""
    return f"""
ranked AS (SELECT {keys}, label, rank() OVER (PARTITION BY {keys} ORDER BY proba)
    + (count(*) OVER (PARTITION BY {keys}, proba) - 1) / 2.0::DOUBLE AS rk FROM {source}),
auc AS (SELECT {keys}, (sum(CASE WHEN label = 1 THEN rk END) - count(*) FILTER (WHERE label = 1)::DOUBLE * (count(*) FILTER (WHERE label = 1) + 1) / 2)
    / nullif(count(*) FILTER (WHERE label = 1)::DOUBLE * count(*) FILTER (WHERE label = 0), 0) AS auc FROM ranked GROUP BY ALL),
steps AS (SELECT {keys}, proba, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM {source} GROUP BY ALL),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER g AS p, sum(neg) OVER g AS n FROM steps
    WINDOW w AS (PARTITION BY {keys} ORDER BY proba DESC), g AS (PARTITION BY {keys})),
ap AS (SELECT {keys}, sum(tp / (tp + fp) * pos / nullif(p, 0)) AS avg_prec FROM curve GROUP BY ALL)"""


RANKED = R.SCORED + "," + ranked_sql("scored", "period")


@Q.query("confusion_matrix", R.sql(CONF, " UNION ALL ".join(
    f"""SELECT period, {real} AS real, {pred} AS pred, {c} AS n, {r(f'{c} / (tn + fp + fn + tp)::DOUBLE * 100', 'pct')} FROM conf"""
    for c, real, pred in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)))))
def confusion_matrix(spark, folder):
    return rounded(mt.confusion_long(mt.confusion(star.scored(spark, folder), BY), BY))


@Q.query("class_metrics", R.sql(CONF, f"""SELECT period, {', '.join(r(e, n) for n, e in CLASS.items())},
    tn + fp AS support_0, fn + tp AS support_1 FROM conf"""))
def class_metrics(spark, folder):
    return rounded(mt.class_metrics(mt.confusion(star.scored(spark, folder), BY), BY))


@Q.query("imbalance_metrics", R.sql(CONF, f"SELECT period, {', '.join(r(e, n) for n, e in IMBALANCE.items())} FROM conf"))
def imbalance_metrics(spark, folder):
    return rounded(mt.imbalance_metrics(mt.confusion(star.scored(spark, folder), BY), BY))


@Q.query("auc_gini", R.sql(RANKED, f"SELECT period, {r('auc', 'auc', 6)}, {r('2 * auc - 1', 'gini', 6)} FROM auc"))
def auc_gini(spark, folder):
    return rounded(mt.rank_metrics(star.scored(spark, folder), BY).drop("avg_prec"), 6)


@Q.query("average_precision", R.sql(RANKED, f"SELECT period, {r('avg_prec', 'avg_prec', 6)} FROM ap"))
def average_precision(spark, folder):
    return rounded(mt.rank_metrics(star.scored(spark, folder), BY).select("period", "avg_prec"), 6)


@Q.query("brier", R.sql(R.SCORED, f"SELECT period, {r('avg((proba - label) * (proba - label))', 'brier', 6)} FROM scored GROUP BY 1"))
def brier(spark, folder):
    return rounded(mt.brier(star.scored(spark, folder), BY), 6)


@Q.query("roc_points", R.sql(RANKED, f"""
    SELECT period, {r('proba', 'threshold', 6)}, {r('fp / nullif(n, 0)', 'fpr', 6)}, {r('tp / nullif(p, 0)', 'tpr', 6)} FROM curve
    UNION ALL SELECT DISTINCT period, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM scored"""))
def roc_points(spark, folder):
    return rounded(mt.roc_points(star.scored(spark, folder), BY), 6)


@Q.query("pr_points", R.sql(RANKED, f"""
    SELECT period, {r('proba', 'threshold', 6)}, {r('tp / (tp + fp)', 'prec', 6)}, {r('tp / nullif(p, 0)', 'recall', 6)} FROM curve
    UNION ALL SELECT DISTINCT period, NULL, 1.0::DOUBLE, 0.0::DOUBLE FROM scored"""))
def pr_points(spark, folder):
    return rounded(mt.pr_points(star.scored(spark, folder), BY), 6)


OTHER = R.SCORED + ", other AS (SELECT period, 1 - label AS label, 1 - proba AS proba FROM scored)," + ranked_sql("other", "period")


@Q.query("roc_points_class_0", R.sql(OTHER + """,
    turns AS (SELECT *, lag(pos) OVER w AS up_pos, lead(pos) OVER w AS low_pos, lead(neg) OVER w AS low_neg FROM curve
      WINDOW w AS (PARTITION BY period ORDER BY proba DESC))""", f"""
    SELECT period, {r('proba', 'threshold', 6)}, {r('fp / nullif(n, 0)', 'fpr', 6)}, {r('tp / nullif(p, 0)', 'tpr', 6)} FROM turns
    WHERE up_pos IS NULL OR low_pos IS NULL OR low_pos <> pos OR low_neg <> neg
    UNION ALL SELECT DISTINCT period, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM scored"""))
def roc_points_class_0(spark, folder):
    """The curve of class 0 without points on straight pieces."""
    return rounded(mt.roc_points(star.scored(spark, folder), BY, pos_label=0, reduced=True), 6)


@Q.query("pr_points_class_0", R.sql(OTHER, f"""
    SELECT period, {r('proba', 'threshold', 6)}, {r('tp / (tp + fp)', 'prec', 6)}, {r('tp / nullif(p, 0)', 'recall', 6)} FROM curve
    UNION ALL SELECT DISTINCT period, NULL, 1.0::DOUBLE, 0.0::DOUBLE FROM scored"""))
def pr_points_class_0(spark, folder):
    return rounded(mt.pr_points(star.scored(spark, folder), BY, pos_label=0), 6)


def sweep_sql(name: str, start: float, stop: float, num: int, degenerate: bool) -> str:
    """Cells and F1 of both classes per period and threshold."""
    zero = "CASE WHEN tp + fp = 0 OR tn + fn = 0 THEN 0 ELSE {} END" if degenerate else "{}"
    f0, f1 = zero.format(CLASS["f1_0"]), zero.format(CLASS["f1_1"])
    return f"""
{name}_grid AS (SELECT i::INTEGER + 1 AS k, CASE WHEN i = {num - 1} THEN {stop!r}::DOUBLE
    ELSE {start!r}::DOUBLE + i * (({stop!r}::DOUBLE - {start!r}::DOUBLE) / {num - 1}) END AS threshold
  FROM generate_series(0, {num - 1}) g(i)),
{name}_steps AS (SELECT period, proba, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY 1, 2),
{name}_cells AS (SELECT period, k, threshold,
    sum(CASE WHEN proba < threshold THEN neg ELSE 0 END)::BIGINT AS tn, sum(CASE WHEN proba >= threshold THEN neg ELSE 0 END)::BIGINT AS fp,
    sum(CASE WHEN proba < threshold THEN pos ELSE 0 END)::BIGINT AS fn, sum(CASE WHEN proba >= threshold THEN pos ELSE 0 END)::BIGINT AS tp
  FROM {name}_steps, {name}_grid GROUP BY ALL),
{name} AS (SELECT *, {f0} AS f1_0, {f1} AS f1_1 FROM {name}_cells)"""


@Q.query("threshold_sweep", R.sql(R.SCORED + "," + sweep_sql("s", 0.01, 0.99, 200, True), f"""SELECT period, k,
    {r('threshold', 'threshold', 6)}, tn, fp, fn, tp, {r('f1_0', 'f1_0', 6)}, {r('f1_1', 'f1_1', 6)},
    {', '.join(r(CLASS[c], c, 6) for c in ('prec_1', 'recall_1', 'prec_0', 'recall_0'))} FROM s"""))
def threshold_sweep(spark, folder):
    return rounded(mt.threshold_sweep(star.scored(spark, folder), mt.GRID_BASELINE, BY, zero_degenerate=True), 6)


def _best_sql(name: str, grid: str, label: int, fallback: str = "threshold") -> str:
    return f"""SELECT '{name}' AS grid, period, {r(f'CASE WHEN f1_{label} > 0 THEN threshold ELSE {fallback} END', 'threshold', 6)},
    {r(f'f1_{label}', 'f1', 6)}, {r(CLASS[f'prec_{label}'], '"precision"', 6)}, {r(CLASS[f'recall_{label}'], 'recall', 6)}
    FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY f1_{label} DESC, threshold) AS rn FROM {grid}) WHERE rn = 1"""


@Q.query("best_threshold", R.sql(
    ",".join([R.SCORED, sweep_sql("a", 0.01, 0.99, 200, True), sweep_sql("b", 0.05, 0.95, 181, False)])
    + f""", c_grid AS (SELECT 0.1::DOUBLE + i * 0.02::DOUBLE AS threshold, i FROM generate_series(0, 39) g(i)),
    c_cells AS (SELECT period, threshold, count(*) FILTER (WHERE label = 0 AND proba < threshold) AS tn, count(*) FILTER (WHERE label = 0 AND proba >= threshold) AS fp,
      count(*) FILTER (WHERE label = 1 AND proba < threshold) AS fn, count(*) FILTER (WHERE label = 1 AND proba >= threshold) AS tp FROM scored, c_grid GROUP BY 1, 2),
    c AS (SELECT *, {CLASS['f1_0']} AS f1_0 FROM c_cells)""",
    " UNION ALL ".join([
        _best_sql("baseline", "a", 1), _best_sql("backtest_0", "b", 0), _best_sql("backtest_1", "b", 1),
        _best_sql("notebook", "c", 0, "0.5::DOUBLE")])))
def best_threshold(spark, folder):
    df = star.scored(spark, folder)
    wide = mt.threshold_sweep(df, mt.GRID_BACKTEST, BY)
    parts = {
        "baseline": mt.best_threshold(mt.threshold_sweep(df, mt.GRID_BASELINE, BY, zero_degenerate=True), BY, 1),
        "backtest_0": mt.best_threshold(wide, BY, 0),
        "backtest_1": mt.best_threshold(wide, BY, 1),
        "notebook": mt.best_threshold(mt.threshold_sweep(df, mt.GRID_NOTEBOOK, BY), BY, 0, fallback=0.5),
    }
    out = None
    for name, part in parts.items():
        row = part.withColumn("grid", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return rounded(out, 6)


FULL = {**CLASS, **IMBALANCE, "auc": "auc", "gini": "2 * auc - 1", "avg_prec": "avg_prec", "brier": "brier",
        "target_rate": "target_rate"}


def full_sql(source: str, keys: str) -> str:
    return ranked_sql(source, keys) + f""",
conf AS (SELECT {keys}, count(*) AS n, {CELLS}, avg((proba - label) * (proba - label)) AS brier,
    avg(label) AS target_rate FROM {source} GROUP BY ALL),
metrics AS (SELECT c.*, auc.auc, ap.avg_prec FROM conf c JOIN auc USING ({keys}) JOIN ap USING ({keys}))"""


FULL_COLUMNS = ("n", "tn", "fp", "fn", "tp", *FULL, "support_0", "support_1")


@Q.query("metrics_by_period", R.sql(R.SCORED + "," + full_sql("scored", "period"),
    f"SELECT period, n, tn, fp, fn, tp, {', '.join(r(e, n) for n, e in FULL.items())}, tn + fp AS support_0, fn + tp AS support_1 FROM metrics"))
def metrics_by_period(spark, folder):
    return rounded(mt.all_metrics(star.scored(spark, folder), BY).select("period", *FULL_COLUMNS))


RIVALS = R.SCORED + """,
rivals AS (SELECT m.model, id, period, label, CASE m.model WHEN 'mixed' THEN proba WHEN 'cents' THEN c ELSE 1 - c END AS proba
  FROM (SELECT s.*, (round(o_totalprice * 100)::BIGINT % 1000) / 1000.0::DOUBLE AS c FROM scored s JOIN orders ON o_orderkey = id),
    (VALUES ('mixed'), ('cents'), ('inverse')) m(model))"""


def rivals(spark, folder):
    """Three scores per order, in long form."""
    cents = F.pmod(F.round(F.col("o_totalprice") * 100).cast("long"), F.lit(1000)) / F.lit(1000.0)
    raw = star.table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), cents.alias("c"))
    models = F.inline(
        F.array(
            F.struct(F.lit("mixed").alias("model"), F.col("proba").alias("proba")),
            F.struct(F.lit("cents").alias("model"), F.col("c").alias("proba")),
            F.struct(F.lit("inverse").alias("model"), (1 - F.col("c")).alias("proba")),
        )
    )
    return star.scored(spark, folder).join(raw, "id").select("id", "period", "label", models)


RIVAL_METRICS = RIVALS + "," + full_sql("rivals", "model, period")


def _rival_metrics(spark, folder):
    return mt.all_metrics(rivals(spark, folder), ["model", "period"])


def _gap(metric: str, alias: str) -> str:
    side = "max(CASE WHEN period = '{}' THEN round({}, 4) END)"
    return f"round({side.format('Train', metric)} - {side.format('Val', metric)}, 4) + 0.0::DOUBLE AS {alias}"


@Q.query("overfit_flags", R.sql(RIVAL_METRICS + f""",
    named AS (SELECT model, period, auc, {CLASS['f1_macro']} AS f1_macro, {IMBALANCE['mcc']} AS mcc FROM metrics),
    gaps AS (SELECT model, {_gap('auc', 'delta_auc')}, {_gap('f1_macro', 'delta_f1')}, {_gap('mcc', 'delta_mcc')}
      FROM named GROUP BY 1)""",
    "SELECT *, coalesce(delta_auc > 0.05 OR delta_f1 > 0.05, false) AS overfit FROM gaps"))
def overfit_flags(spark, folder):
    return rounded(mt.overfit_flags(_rival_metrics(spark, folder), ["model"]))


@Q.query("leaderboard", R.sql(RIVAL_METRICS, f"""SELECT model, {r('auc', 'auc', 6)}, {r(IMBALANCE['mcc'], 'mcc', 6)},
    {r(CLASS['f1_0'], 'f1_0', 6)}, row_number() OVER (ORDER BY round(auc, 6) DESC, round({IMBALANCE['mcc']}, 6) DESC,
      round({CLASS['f1_0']}, 6) DESC, model)::INTEGER AS rank FROM metrics WHERE period = 'Val'"""))
def leaderboard(spark, folder):
    val = rounded(_rival_metrics(spark, folder).where("period = 'Val'").select("model", "auc", "mcc", "f1_0"), 6)
    return mt.leaderboard(val, "model")


@Q.query("best_model", R.sql(RIVAL_METRICS + ", v AS (SELECT model, round(auc, 6) AS auc FROM metrics WHERE period = 'Val')",
    "SELECT (SELECT model FROM v ORDER BY auc DESC, model LIMIT 1) AS best, (SELECT max(auc) FROM v) AS auc"))
def best_model(spark, folder):
    val = rounded(_rival_metrics(spark, folder).where("period = 'Val'").select("model", "auc"), 6)
    return mt.best_model(val, "model", "auc")


@Q.query("model_intersection", R.sql(RIVAL_METRICS, """SELECT model FROM metrics WHERE period = 'Val' AND round(auc, 6) >= 0.4
    INTERSECT SELECT model FROM metrics WHERE period = 'Backtest' AND round(avg_prec, 6) >= 0.3"""))
def model_intersection(spark, folder):
    m = rounded(_rival_metrics(spark, folder).select("model", "period", "auc", "avg_prec"), 6)
    first = m.where("period = 'Val' AND auc >= 0.4").select("model")
    return first.intersect(m.where("period = 'Backtest' AND avg_prec >= 0.3").select("model"))


@Q.query("baseline_vs_tuned", R.sql(RIVAL_METRICS, f"""SELECT b.model, {r('b.auc', 'base', 6)}, {r('t.auc', 'tuned', 6)},
    {r('round(t.auc, 6) - round(b.auc, 6)', 'delta', 6)}
    FROM metrics b JOIN metrics t ON b.model = t.model AND b.period = 'Val' AND t.period = 'Backtest'"""))
def baseline_vs_tuned(spark, folder):
    m = rounded(_rival_metrics(spark, folder).select("model", "period", "auc"), 6)
    return rounded(mt.compare_runs(m.where("period = 'Val'"), m.where("period = 'Backtest'"), "model", "auc"), 6)


@Q.query("cv_summary", R.sql(RIVALS + f""",
    folds AS (SELECT id, ((row_number() OVER (PARTITION BY label ORDER BY md5(id::VARCHAR || ':2357'), id) - 1) % 5)::INTEGER AS fold
      FROM scored),
    conf AS (SELECT model, fold, {CELLS} FROM rivals JOIN folds USING (id) GROUP BY 1, 2),
    s AS (SELECT model, fold, {CLASS['f1_0']} AS f1 FROM conf)""",
    f"SELECT model, count(*) AS folds, {r('avg(f1)', 'cv_f1_mean')}, {r('stddev_pop(f1)', 'cv_f1_std')} FROM s GROUP BY 1"))
def cv_summary(spark, folder):
    folds = pr.stratified_folds(star.scored(spark, folder).select("id", "label"), "label", "id").select("id", "fold")
    scores = mt.class_metrics(mt.confusion(rivals(spark, folder).join(folds, "id"), ["model", "fold"]), ["model", "fold"])
    return rounded(
        scores.groupBy("model").agg(
            F.count("*").alias("folds"), F.avg("f1_0").alias("cv_f1_mean"), F.stddev_pop("f1_0").alias("cv_f1_std")
        )
    )


@Q.query("calibration_curve", R.sql(R.SCORED + """,
    e AS (SELECT list(i * 0.1::DOUBLE ORDER BY i) AS edges FROM generate_series(1, 9) g(i)),
    b AS (SELECT *, (1 + len(list_filter(edges, lambda x: proba > x)))::INTEGER AS bin FROM scored, e)""",
    f"""SELECT period, bin, count(*) AS n, {r('avg(proba)', 'mean_predicted', 6)},
    {r('avg(label)', 'fraction_positive', 6)} FROM b GROUP BY 1, 2"""))
def calibration_curve(spark, folder):
    return rounded(mt.calibration_curve(star.scored(spark, folder), BY), 6)


ORDERED = R.SCORED + """,
ordered AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY proba, id) AS pos, count(*) OVER (PARTITION BY period) AS n,
    sum(1 - label) OVER (PARTITION BY period) AS bad FROM scored)"""


@Q.query("lift_by_decile", R.sql(ORDERED, f"""SELECT period, greatest(1, ceil((pos - 1) * 10 / (n - 1)))::INTEGER AS decil,
    count(*) AS clientes, sum(1 - label)::BIGINT AS insatisfechos, {r('avg(1 - label)', 'tasa', 6)},
    {r('avg(1 - label) / (max(bad) / max(n))', 'lift', 6)} FROM ordered GROUP BY 1, 2"""))
def lift_by_decile(spark, folder):
    return rounded(mt.lift_by_decile(star.scored(spark, folder), BY), 6)


@Q.query("cumulative_lift", R.sql(ORDERED, f"""SELECT period, (i * 10)::INTEGER AS pct, count(*) AS contacted,
    sum(1 - label)::BIGINT AS captured, {r('avg(1 - label) / (max(bad) / max(n))', 'lift', 6)}
    FROM ordered, generate_series(1, 10) g(i) WHERE pos <= n * i // 10 GROUP BY 1, 2"""))
def cumulative_lift(spark, folder):
    return rounded(mt.cumulative_lift(star.scored(spark, folder), BY), 6)


@Q.query("cumulative_gains", R.sql(ORDERED, f"""SELECT period, id, pos, {r('pos / n * 100', 'pct_population', 6)},
    {r('sum(1 - label) OVER (PARTITION BY period ORDER BY pos) / nullif(bad, 0) * 100', 'pct_captured', 6)} FROM ordered"""))
def cumulative_gains(spark, folder):
    return rounded(mt.cumulative_gains(star.scored(spark, folder), BY), 6)


@Q.query("target_rate", R.sql(R.SCORED, f"SELECT period, count(*) AS n, {r('avg(label)', 'rate')} FROM scored GROUP BY 1"))
def target_rate(spark, folder):
    return rounded(mt.rates(star.scored(spark, folder), BY))


@Q.query("psi_scores", R.sql(R.SCORED + f""",
    e AS (SELECT quantile_cont(proba, [{', '.join(f'{i / 10}' for i in range(1, 10))}]) AS edges FROM scored WHERE period = 'Train'),
    b AS (SELECT period, len(list_filter(edges, lambda x: proba >= x)) AS bin FROM scored, e),
    p AS (SELECT o.period, bin, count(*) FILTER (WHERE b.period = 'Train')::DOUBLE AS ref, count(*) FILTER (WHERE b.period = o.period)::DOUBLE AS act
      FROM b, (VALUES ('Val'), ('Backtest')) o(period) GROUP BY 1, 2),
    s AS (SELECT period, CASE WHEN ref = 0 THEN 1e-4::DOUBLE ELSE ref / sum(ref) OVER (PARTITION BY period) END AS e,
      CASE WHEN act = 0 THEN 1e-4::DOUBLE ELSE act / sum(act) OVER (PARTITION BY period) END AS a FROM p),
    t AS (SELECT period, sum((a - e) * ln(a / e)) AS psi FROM s GROUP BY 1)""",
    f"""SELECT period, {r('psi', 'psi', 6)},
    CASE WHEN psi >= 0.25 THEN 'critico' WHEN psi >= 0.10 THEN 'alerta' ELSE 'estable' END AS band FROM t"""))
def psi_scores(spark, folder):
    return rounded(drift.score_psi(star.scored(spark, folder), "proba", "period", "Train", ["Val", "Backtest"]), 6)


@Q.query("ks_statistic", R.sql(R.SCORED + """,
    v AS (SELECT proba, count(*) FILTER (WHERE period = 'Train') AS t, count(*) FILTER (WHERE period = 'Val') AS a, count(*) FILTER (WHERE period = 'Backtest') AS b
      FROM scored GROUP BY 1),
    c AS (SELECT sum(t) OVER w / sum(t) OVER () AS ct, sum(a) OVER w / sum(a) OVER () AS ca, sum(b) OVER w / sum(b) OVER () AS cb
      FROM v WINDOW w AS (ORDER BY proba))""",
    f"""SELECT 'Val' AS period, {r('max(abs(ct - ca))', 'ks', 6)} FROM c
    UNION ALL SELECT 'Backtest', {r('max(abs(ct - cb))', 'ks', 6)} FROM c"""))
def ks_statistic(spark, folder):
    return rounded(drift.ks_statistics(star.scored(spark, folder), "proba", "period", "Train", ["Val", "Backtest"]), 6)


_BINS = 40


@Q.query("score_histogram", R.sql(R.SCORED + f""",
    x AS (SELECT label AS class, proba AS v FROM scored),
    h AS (SELECT class, least(floor(v * {_BINS})::INTEGER + 1, {_BINS}) AS bin FROM x WHERE v BETWEEN 0 AND 1)""",
    f"""SELECT class, bin, count(*) AS n, {r(f'count(*) / (sum(count(*)) OVER (PARTITION BY class) / {_BINS})', 'density', 6)}
    FROM h GROUP BY 1, 2"""))
def score_histogram(spark, folder):
    return rounded(ag.value_histogram(star.scored(spark, folder), "proba", 0.0, 1.0, _BINS, "label"), 6)


def _label(c: str) -> str:
    return f"CASE WHEN {c} = 1 THEN 'Satisfecho' ELSE 'Insatisfecho' END"


_P05, _P07 = "CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END", "CASE WHEN proba >= 0.7 THEN 1 ELSE 0 END"


@Q.query("scored_predictions", R.sql(R.SCORED, f"""SELECT id, period, label AS y_real, {_label('label')} AS y_real_etiqueta,
    {r('proba', 'proba_satisfecho', 6)}, {_P05} AS prediccion, {_label(f'({_P05})')} AS prediccion_etiqueta,
    CASE WHEN ({_P05}) = label THEN 1 ELSE 0 END AS correcto, {_P07} AS prediccion_umbral_opt,
    {_label(f'({_P07})')} AS prediccion_umbral_opt_etiqueta,
    CASE WHEN ({_P07}) = label THEN 1 ELSE 0 END AS correcto_umbral_opt FROM scored"""))
def scored_predictions(spark, folder):
    return mt.scored_predictions(star.scored(spark, folder), threshold=0.7)


@Q.query("hit_rate_by_class", R.sql(R.SCORED, f"""SELECT {_label('label')} AS y_real_etiqueta, count(*) AS total,
    sum(CASE WHEN ({_P05}) = label THEN 1 ELSE 0 END)::BIGINT AS correctos,
    {r(f'avg(CASE WHEN ({_P05}) = label THEN 1 ELSE 0 END)', 'tasa_acierto')} FROM scored GROUP BY 1"""))
def hit_rate_by_class(spark, folder):
    scored = mt.scored_predictions(star.scored(spark, folder), threshold=0.7)
    return rounded(ag.hit_rate_by_class(scored, "y_real_etiqueta", "correcto"))


@Q.query("metric_history_trend", R.sql(R.SCORED + f""",
    monthly AS (SELECT s.*, strftime(o_orderdate, '%Y-%m') AS month FROM scored s JOIN orders ON o_orderkey = id),
    {full_sql('monthly', 'month').strip()}""",
    f"""SELECT month AS "timestamp", row_number() OVER (ORDER BY month)::INTEGER AS run, n AS n_registros,
    {r('auc', 'auc_roc')}, {r(CLASS['accuracy'], 'accuracy')}, {r(CLASS['f1_0'], 'f1_clase_0')} FROM metrics"""))
def metric_history_trend(spark, folder):
    months = star.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), ex.year_month(F.col("o_orderdate")).alias("month")
    )
    monthly = mt.all_metrics(star.scored(spark, folder).join(months, "id"), ["month"])
    history = monthly.select(
        F.col("month").alias("timestamp"), F.col("n").alias("n_registros"), F.col("auc").alias("auc_roc"),
        "accuracy", F.col("f1_0").alias("f1_clase_0"),
    )
    return rounded(sinks.history_trend(history))


@Q.query("sigmoid_score", f"""SELECT c_custkey, {r('1 / (1 + exp(-(c_acctbal - 5000) / 1000))', 'proba', 6)} FROM customer""")
def sigmoid_score(spark, folder):
    c = star.table(spark, folder, "customer")
    return rounded(c.select("c_custkey", ex.sigmoid((F.col("c_acctbal") - 5000) / 1000).alias("proba")), 6)


LINEAR = ("price", "balance", "hour")
INTERCEPT = 0.25
_Z = "(({c} - (SELECT avg({c}) FROM t WHERE split = 'train')) / (SELECT stddev_pop({c}) FROM t WHERE split = 'train'))"
LINEAR_SQL = LABELLED_SQL + f""",
t AS (SELECT order_id, split, satisfecho, price, balance, hour(order_purchase_timestamp)::DOUBLE AS hour FROM labelled),
z AS (SELECT order_id, split, satisfecho, {', '.join(f'{_Z.format(c=c)} AS {c}' for c in LINEAR)} FROM t),
w AS (SELECT {', '.join(f"round(corr({c}, satisfecho), 6) AS w_{c}" for c in LINEAR)} FROM z WHERE split = 'train')"""
_LOGIT = f"{INTERCEPT} + " + " + ".join(f"w_{c} * {c}" for c in LINEAR)


def linear_frame(spark, folder):
    """Standardised features and one fitted weight per feature."""
    df = labelled(spark, folder).select(
        "order_id", "split", "satisfecho", "price", "balance",
        F.hour("order_purchase_timestamp").cast("double").alias("hour"),
    )
    z = pr.standardize(df, LINEAR)
    train = z.where("split = 'train'")
    weights = {
        row["feature"]: row["r"] for row in rounded(ag.correlation_with(train, "satisfecho", LINEAR), 6).collect()
    }
    return z, {c: weights[c] for c in LINEAR}


@Q.query("linear_score", R.sql(LINEAR_SQL, f"""SELECT order_id, {r(f'1 / (1 + exp(-({_LOGIT})))', 'proba', 6)},
    CASE WHEN 1 / (1 + exp(-({_LOGIT}))) >= 0.5 THEN 1 ELSE 0 END AS pred FROM z, w"""))
def linear_score(spark, folder):
    z, weights = linear_frame(spark, folder)
    return rounded(explain.linear_score(z, weights, INTERCEPT).select("order_id", "proba", "pred"), 6)


SHAP_SQL = LINEAR_SQL + f""",
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}' for c in LINEAR)} FROM z),
phi AS (SELECT order_id, {', '.join(f'{c}, w_{c} * ({c} - m_{c}) AS phi_{c}' for c in LINEAR)},
  {INTERCEPT} + {' + '.join(f'w_{c} * m_{c}' for c in LINEAR)} AS base_value FROM z, w, m)"""


def _attributed(spark, folder):
    z, weights = linear_frame(spark, folder)
    return explain.linear_attributions(z, weights, INTERCEPT)


@Q.query("linear_shap", R.sql(SHAP_SQL, f"""SELECT order_id, {', '.join(r(f'phi_{c}', f'phi_{c}', 6) for c in LINEAR)},
    {r('base_value', 'base_value', 6)} FROM phi"""))
def linear_shap(spark, folder):
    out = _attributed(spark, folder)
    return rounded(out.select("order_id", *[f"phi_{c}" for c in LINEAR], "base_value"), 6)


@Q.query("shap_top_features", R.sql(SHAP_SQL, "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'avg(abs(phi_{c}))', 'mean_abs_shap', 6)} FROM phi" for c in LINEAR)
    + ") ORDER BY mean_abs_shap DESC, feature LIMIT 5"))
def shap_top_features(spark, folder):
    return rounded(explain.top_features(_attributed(spark, folder), LINEAR, 5), 6)


@Q.query("shap_row", R.sql(SHAP_SQL, " UNION ALL ".join(
    f"""SELECT order_id, {r('base_value', 'base_value', 6)}, '{c}' AS feature, {r(c, 'value', 6)},
    {r(f'phi_{c}', 'phi', 6)} FROM phi WHERE order_id = 0""" for c in LINEAR)))
def shap_row(spark, folder):
    return rounded(explain.explain_row(_attributed(spark, folder), LINEAR, "order_id", 0), 6)
