"""Feature-filter and champion-rule queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators import aggregates as ag, drift, explain, selection as sel
from orderpulse.registry import Registry, r, roles_sql as R, rounded
from orderpulse.sources import star
from orderpulse.sources.staging import stage

Q = Registry()

CUT = "1998-06-30"
FEATURES = (
    "x_quantity", "x_price", "x_discount", "x_tax", "x_net", "x_charge", "x_unit", "x_line", "x_constant", "x_gappy",
)

WIDE_SQL = f"""
wide AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
    CASE WHEN l_shipdate <= TIMESTAMP '{CUT}' THEN 'train' ELSE 'val' END AS split,
    l_quantity AS x_quantity, l_extendedprice AS x_price, l_discount AS x_discount, l_tax AS x_tax,
    l_extendedprice * (1 - l_discount) AS x_net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS x_charge,
    l_extendedprice / l_quantity AS x_unit, l_linenumber::DOUBLE AS x_line, 1.0::DOUBLE AS x_constant,
    nullif(l_discount, 0.0::DOUBLE) * l_quantity AS x_gappy
  FROM lineitem),
long AS (SELECT label, split, feature, value FROM wide
  UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(FEATURES)})))"""


def wide(spark, folder):
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    net = price * (1 - disc)
    return star.table(spark, folder, "lineitem").select(
        ex.flag(F.col("l_returnflag") == "R").alias("label"),
        F.when(F.col("l_shipdate") <= F.lit(CUT).cast("timestamp_ntz"), "train").otherwise("val").alias("split"),
        F.col("l_quantity").alias("x_quantity"), price.alias("x_price"), disc.alias("x_discount"),
        tax.alias("x_tax"), net.alias("x_net"), (net * (1 + tax)).alias("x_charge"),
        (price / F.col("l_quantity")).alias("x_unit"), F.col("l_linenumber").cast("double").alias("x_line"),
        F.lit(1.0).alias("x_constant"), (F.nullif(disc, F.lit(0.0)) * F.col("l_quantity")).alias("x_gappy"),
    )


def train():
    return F.col("split") == "train"


def val():
    return F.col("split") == "val"


@Q.query("select_nonconstant", R.sql(WIDE_SQL, """SELECT feature,
    CASE WHEN count(DISTINCT value) > 1 THEN 1 ELSE 0 END AS varies FROM long WHERE split = 'train' GROUP BY 1"""))
def select_nonconstant(spark, folder):
    return sel.nonconstant_table(wide(spark, folder).where(train()), FEATURES)


@Q.query("select_missing", R.sql(WIDE_SQL, """SELECT t.threshold, feature,
    count(*) FILTER (WHERE value IS NULL) / count(*) > t.threshold AS removed
    FROM long, (VALUES (0.05::DOUBLE), (0.15::DOUBLE)) t(threshold) WHERE split = 'train' GROUP BY 1, 2"""))
def select_missing(spark, folder):
    df = wide(spark, folder).where(train())
    rows = []
    for t in (0.05, 0.15):
        _, removed = sel.by_missing(df, FEATURES, t)
        rows += [(t, f, f in removed) for f in FEATURES]
    return spark.createDataFrame(rows, "threshold double, feature string, removed boolean")


PSI_SQL = WIDE_SQL + f""",
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{', '.join(f'{i / 10}' for i in range(11))}]))) AS e
  FROM long WHERE split = 'train' AND value IS NOT NULL GROUP BY 1),
binned AS (SELECT feature, split, CASE WHEN value >= e[1] AND value <= e[len(e)]
    THEN len(list_filter(e[2:len(e) - 1], lambda x: value >= x)) ELSE -1 END AS bin
  FROM long JOIN edges USING (feature) WHERE value IS NOT NULL AND len(e) >= 2),
sides AS (SELECT feature, bin, count(*) FILTER (WHERE split = 'train')::DOUBLE AS ref, count(*) FILTER (WHERE split = 'val')::DOUBLE AS act,
    sum(count(*) FILTER (WHERE split = 'train')) OVER (PARTITION BY feature) AS n_ref,
    sum(count(*) FILTER (WHERE split = 'val')) OVER (PARTITION BY feature) AS n_act FROM binned GROUP BY 1, 2),
shares AS (SELECT feature, CASE WHEN ref = 0 THEN 1e-6::DOUBLE ELSE ref / n_ref END AS e,
    CASE WHEN act = 0 THEN 1e-6::DOUBLE ELSE act / n_act END AS a FROM sides WHERE bin >= 0),
psi AS (SELECT f.feature, round(coalesce(sum((a - s.e) * ln(a / s.e)), 0), 4) + 0.0::DOUBLE AS psi
  FROM (SELECT DISTINCT feature FROM long) f LEFT JOIN shares s USING (feature) GROUP BY 1)"""


@Q.query("psi_features", R.sql(PSI_SQL, "SELECT feature, psi FROM psi"))
def psi_features(spark, folder):
    return rounded(drift.feature_psi(wide(spark, folder), FEATURES, train(), val()))


# the splits drift very little, so the filter is shown at a threshold that bites
_PSI_CUT = 0.0002


@Q.query("select_psi", R.sql(PSI_SQL, f"SELECT feature, psi > {_PSI_CUT}::DOUBLE AS removed FROM psi"))
def select_psi(spark, folder):
    values = sel.psi_values(wide(spark, folder), FEATURES, train(), val())
    _, removed = sel.by_psi(values, FEATURES, _PSI_CUT)
    return spark.createDataFrame([(f, f in removed) for f in FEATURES], "feature string, removed boolean")


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM train" for a, b in combinations(FEATURES, 2)
)
CORR_SQL = WIDE_SQL + f""", train AS (SELECT * FROM wide WHERE split = 'train'),
pairs AS (SELECT a, b, CASE WHEN isnan(r) THEN NULL ELSE r END AS r FROM ({_PAIRS}))"""


@Q.query("select_correlation", R.sql(CORR_SQL, f"""SELECT b AS feature, {r('max(abs(r))', 'max_abs_r')},
    coalesce(max(abs(r)) > 0.9, false) AS removed FROM pairs GROUP BY 1"""))
def select_correlation(spark, folder):
    return rounded(sel.correlated_features(wide(spark, folder).where(train()), FEATURES, 0.9))


AUC_SQL = WIDE_SQL + """,
ranked AS (SELECT feature, label, rank() OVER (PARTITION BY feature ORDER BY value)
    + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0::DOUBLE AS rk
  FROM long WHERE split = 'val' AND value IS NOT NULL),
aucs AS (SELECT feature, round((sum(CASE WHEN label = 1 THEN rk END) - count(*) FILTER (WHERE label = 1)::DOUBLE * (count(*) FILTER (WHERE label = 1) + 1) / 2)
    / (count(*) FILTER (WHERE label = 1)::DOUBLE * count(*) FILTER (WHERE label = 0)), 6) AS auc FROM ranked GROUP BY 1)"""


@Q.query("univariate_auc", R.sql(AUC_SQL, "SELECT feature, auc FROM aucs"))
def univariate_auc(spark, folder):
    return rounded(sel.univariate_auc(wide(spark, folder).where(val()), FEATURES, "label"), 6)


@Q.query("select_variance", R.sql(WIDE_SQL, f"""SELECT feature, {r('var_pop(coalesce(value, 0))', 'variance', 2)},
    var_pop(coalesce(value, 0)) <= 0.01 AS removed FROM long WHERE split = 'train' GROUP BY 1"""))
def select_variance(spark, folder):
    out = sel.variances(wide(spark, folder).where(train()), FEATURES)
    return rounded(out.withColumn("removed", ~(F.col("variance") > 0.01)), 2)


_STEPS = ((1, 1, 0.0), (1, 2, 0.0005), (1, 3, 0.002), (2, 1, 0.001), (2, 2, 0.001), (2, 3, 0.4))
_STEP_VALUES = ", ".join(f"({p}, {o}, {t}::DOUBLE)" for p, o, t in _STEPS)


def _candidates(spark, folder):
    """Per threshold: features whose AUC is far enough from one half, and their best AUC."""
    # read twice: its rows are few, its ranking is not
    aucs = stage(univariate_auc(spark, folder), "aucs")
    base = aucs.agg(F.round(F.avg("auc"), 6)).scalar()
    rows = [
        F.struct(
            F.lit(p).alias("paso"), F.lit(o).alias("ord"), F.lit(t).alias("threshold"),
            F.count_if(F.abs(F.col("auc") - 0.5) >= t).alias("n_features"),
            F.max(F.when(F.abs(F.col("auc") - 0.5) >= t, F.col("auc"))).alias("auc_val"),
        )
        for p, o, t in _STEPS
    ]
    return aucs.agg(F.array(*rows).alias("m")).select(F.inline("m")).withColumn("base_auc", base)


CANDIDATES_SQL = AUC_SQL + f""",
candidates AS (SELECT paso, ord, threshold, count(*) FILTER (WHERE abs(auc - 0.5) >= threshold) AS n_features,
    max(CASE WHEN abs(auc - 0.5) >= threshold THEN auc END) AS auc_val,
    (SELECT round(avg(auc), 6) FROM aucs) AS base_auc
  FROM aucs, (VALUES {_STEP_VALUES}) s(paso, ord, threshold) GROUP BY 1, 2, 3),
chosen AS (SELECT *, coalesce(row_number() OVER (PARTITION BY paso ORDER BY
    (auc_val IS NOT NULL AND n_features > 0 AND auc_val >= base_auc - 0.005)::INTEGER DESC, auc_val DESC NULLS LAST, ord) = 1
    AND auc_val IS NOT NULL AND n_features > 0 AND auc_val >= base_auc - 0.005, false) AS elegido FROM candidates)"""


@Q.query("selection_winner", R.sql(CANDIDATES_SQL, f"""SELECT paso, ord, threshold, n_features, {r('auc_val', 'auc_val', 6)},
    {r('base_auc', 'base_auc', 6)}, elegido FROM chosen"""))
def selection_winner(spark, folder):
    return rounded(sel.winners(_candidates(spark, folder)), 6)


@Q.query("selection_detail", R.sql(CORR_SQL + """,
    worst AS (SELECT b AS feature, max(abs(r)) AS m FROM pairs GROUP BY 1)""",
    """SELECT 3 AS paso, 'correlation_method' AS metodo, t.threshold, feature AS feature_eliminada,
    t.threshold = '0.95' AS paso_elegido FROM worst, (VALUES ('0.8'), ('0.9'), ('0.95')) t(threshold)
    WHERE m > t.threshold::DOUBLE"""))
def selection_detail(spark, folder):
    worst = sel.correlated_features(wide(spark, folder).where(train()), FEATURES, 0.9)
    rows = [
        F.struct(
            F.lit(3).alias("paso"), F.lit("correlation_method").alias("metodo"), F.lit(t).alias("threshold"),
            # one entry per feature
            F.collect_list(F.when(F.col("max_abs_r") > float(t), F.col("feature"))).alias("features_eliminadas"),
            F.lit(t == "0.95").alias("elegido"),
        )
        for t in ("0.8", "0.9", "0.95")
    ]
    return sel.removed_detail(worst.agg(F.array(*rows).alias("m")).select(F.inline("m")))


@Q.query("importance_delta", R.sql(WIDE_SQL + """,
    imp AS (SELECT split, feature, round(abs(corr(value, label)), 6) AS i FROM long
      WHERE feature <> 'x_constant' GROUP BY 1, 2)""",
    f"""SELECT b.feature, {r('b.i', 'base', 6)}, {r('t.i', 'tuned', 6)},
    {r('(t.i - b.i) / nullif(abs(b.i), 0) * 100', 'delta_pct')}
    FROM imp b JOIN imp t ON b.feature = t.feature AND b.split = 'train' AND t.split = 'val'
    ORDER BY t.i DESC, b.feature LIMIT 15"""))
def importance_delta(spark, folder):
    names = [f for f in FEATURES if f != "x_constant"]
    size = F.round(F.abs("r"), 6).alias("importance")
    base = ag.correlation_with(wide(spark, folder).where(train()), "label", names).select("feature", size)
    tuned = ag.correlation_with(wide(spark, folder).where(val()), "label", names).select("feature", size)
    out = explain.importance_delta(base, tuned, 15)
    return out.select(
        "feature", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("base", "tuned")],
        (F.round("delta_pct", 4) + F.lit(0.0)).alias("delta_pct"),
    )
