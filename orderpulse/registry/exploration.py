"""KPI, frequency, describe, correlation and class-profile queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from orderpulse.functions import expressions as ex
from orderpulse.operators import aggregates as ag, drift
from orderpulse.registry import Registry, frames, r, roles_sql as R, rounded
from orderpulse.sources import star

Q = Registry()


@Q.query("mean_by_key", R.sql(R.EDA, f"""SELECT customer_state, {r('avg(review_score)', 'mean')} FROM eda
    WHERE customer_state IS NOT NULL GROUP BY 1"""))
def mean_by_key(spark, folder):
    return rounded(ag.mean_by_key(frames.explored(spark, folder), "customer_state", "review_score"))


_MULTI = ("total_price", "total_freight_value", "freight_ratio")


@Q.query("multi_mean_by_score", R.sql(R.EDA, f"""SELECT review_score,
    {', '.join(f'round(avg({c}), 2) AS {c}' for c in _MULTI)} FROM eda
    WHERE review_score IS NOT NULL GROUP BY 1"""))
def multi_mean_by_score(spark, folder):
    return ag.means_by_key(frames.explored(spark, folder), "review_score", _MULTI)


_CATEGORY = f"""SELECT product_category_name_english, {r('avg(review_score)', 'avg_score')}, count(order_id) AS orders
    FROM eda WHERE product_category_name_english IS NOT NULL GROUP BY 1 HAVING count(order_id) >= 100"""


@Q.query("category_satisfaction", R.sql(R.EDA, _CATEGORY))
def category_satisfaction(spark, folder):
    return rounded(
        ag.category_satisfaction(frames.explored(spark, folder), "product_category_name_english", min_orders=100)
    )


@Q.query("top_bottom_categories", R.sql(R.EDA + f", c AS ({_CATEGORY})", """
    (SELECT *, 'bottom' AS side FROM c ORDER BY avg_score, product_category_name_english LIMIT 5)
    UNION ALL
    (SELECT *, 'top' AS side FROM c ORDER BY avg_score DESC, product_category_name_english LIMIT 5)"""))
def top_bottom_categories(spark, folder):
    return ag.top_and_bottom(category_satisfaction(spark, folder), "avg_score", "product_category_name_english", 5)


_MONTHLY = """SELECT mes_compra AS month, avg(review_score) AS avg_score, count(order_id) AS orders
    FROM eda WHERE mes_compra IS NOT NULL GROUP BY 1 HAVING count(order_id) >= 50"""


@Q.query("monthly_trend", R.sql(R.EDA + f", m AS ({_MONTHLY})", f"SELECT month, {r('avg_score', 'avg_score')}, orders FROM m"))
def monthly_trend(spark, folder):
    return rounded(ag.monthly_trend(frames.explored(spark, folder)))


@Q.query("best_worst_month", R.sql(R.EDA + f", m0 AS ({_MONTHLY}), m AS (SELECT month, round(avg_score, 6) AS s FROM m0)", f"""
    SELECT (SELECT month FROM m ORDER BY s DESC, month LIMIT 1) AS best,
           (SELECT month FROM m ORDER BY s, month LIMIT 1) AS worst,
           {r('(SELECT avg(s) FROM m)', 'mean_measure')}, (SELECT count(*) FROM m) AS "groups" """))
def best_worst_month(spark, folder):
    monthly = rounded(ag.monthly_trend(frames.explored(spark, folder)), 6)
    return rounded(ag.best_and_worst(monthly, "month", "avg_score"))


@Q.query("frequency_table", R.sql(R.REVIEWS, f"""SELECT review_score, count(*) AS n,
    {r('count(*) / sum(count(*)) OVER ()', 'share', 6)}, {r('count(*) / sum(count(*)) OVER () * 100', 'percent', 6)}
    FROM reviews_r WHERE review_score IS NOT NULL GROUP BY 1"""))
def frequency_table(spark, folder):
    return rounded(ag.frequency_table(star.reviews(spark, folder), "review_score"), 6)


_KPI = {
    "customer_satisfaction_rate": "count(*) FILTER (WHERE review_score >= 4) / nullif(count(review_score), 0) * 100",
    "unsatisfied_rate": "count(*) FILTER (WHERE review_score <= 3) / nullif(count(review_score), 0) * 100",
    "average_review_score": "avg(review_score)",
    "late_delivery_rate": "avg(es_tarde) * 100",
    "average_delivery_delay": "avg(dias_retraso)",
    "average_late_days": "avg(CASE WHEN dias_retraso > 0 THEN dias_retraso END)",
    "revenue_at_risk": "coalesce(sum(CASE WHEN review_score <= 3 THEN payment_value END), 0)",
    "average_order_value": "avg(payment_value)",
}


def _kpis() -> str:
    # large money sums compare at whole units
    return ", ".join(r(e, n, 0 if n == "revenue_at_risk" else 3) for n, e in _KPI.items())


@Q.query("kpi_scalar", R.sql(R.EDA, f"SELECT count(*) AS orders, {_kpis()} FROM eda"))
def kpi_scalar(spark, folder):
    return rounded(ag.kpi_totals(frames.explored(spark, folder)).withColumn("revenue_at_risk", F.round("revenue_at_risk", 0)), 3)


_EDA_KPI = {
    "customer_satisfaction_rate": "count(*) FILTER (WHERE review_score >= 4) / nullif(count(review_score), 0) * 100",
    "unsatisfied_rate": "count(*) FILTER (WHERE review_score <= 3) / nullif(count(review_score), 0) * 100",
    "average_review_score": "avg(review_score)",
    "late_delivery_rate": "count(*) FILTER (WHERE NOT coalesce(dias_retraso <= 0, false)) / count(*) * 100",
    "average_delay_days": "avg(dias_retraso) FILTER (WHERE dias_retraso > 0)",
    "average_order_value": "avg(payment_value)",
}


@Q.query("kpi_exploration", R.sql(R.EDA, f"""SELECT count(*) AS orders, {', '.join(r(e, n, 3) for n, e in _EDA_KPI.items())},
    {r('coalesce(sum(payment_value) FILTER (WHERE review_score <= 3), 0)', 'revenue_at_risk', 0)}
    FROM eda WHERE order_status = 'delivered'"""))
def kpi_exploration(spark, folder):
    """KPIs of the delivered orders with the exploration's denominators."""
    found = ag.kpi_exploration(frames.explored(spark, folder).where("order_status = 'delivered'"))
    return rounded(found.withColumn("revenue_at_risk", F.round("revenue_at_risk", 0)), 3)


_DIMS = ("customer_state", "payment_type", "order_item_count", "review_score", "es_tarde")


@Q.query("kpi_by_dim", R.sql(R.EDA, " UNION ALL ".join(
    f"""SELECT '{d}' AS dimension, {d}::VARCHAR AS value, {r('avg(review_score)', 'mean_score')}, count(*) AS orders
    FROM eda WHERE {d} IS NOT NULL GROUP BY {d}""" for d in _DIMS)))
def kpi_by_dim(spark, folder):
    return rounded(ag.kpi_by_dimension(frames.explored(spark, folder), _DIMS))


@Q.query("region_satisfaction", R.sql(",".join([R.EDA, R.REGIONS]), f"""
    SELECT coalesce(region, 'outro') AS customer_region, count(*) AS orders,
      {r('avg(satisfecho)', 'satisfaction')}, {r('avg(es_tarde)', 'late_rate')},
      {r('coalesce(sum(CASE WHEN review_score <= 3 THEN payment_value END), 0)', 'revenue_at_risk', 0)}
    FROM eda LEFT JOIN regions_r ON state = customer_state WHERE order_status = 'delivered' GROUP BY 1"""))
def region_satisfaction(spark, folder):
    """Satisfaction, late share and revenue at risk of delivered orders per region."""
    regions = star.state_regions(spark, folder).withColumnRenamed("state", "customer_state")
    out = (
        frames.explored(spark, folder)
        .where("order_status = 'delivered'")
        .join(regions, "customer_state", "left")
        .groupBy(F.coalesce("region", F.lit("outro")).alias("customer_region"))
        .agg(
            F.count("*").alias("orders"),
            F.avg("satisfecho").alias("satisfaction"),
            F.avg("es_tarde").alias("late_rate"),
            F.coalesce(F.sum(F.when(F.col("review_score") <= 3, F.col("payment_value"))), F.lit(0.0)).alias("risk"),
        )
    )
    return out.select(
        "customer_region", "orders",
        *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("satisfaction", "late_rate")],
        (F.round("risk", 0) + F.lit(0.0)).alias("revenue_at_risk"),
    )


@Q.query("baseline_business_metrics", R.sql(R.EDA, f"""SELECT count(*) AS orders,
    {r('avg(review_score)', 'mean_score')}, {r('avg(satisfecho) * 100', 'pct_satisfied')},
    {r('avg(delivered_on_time) * 100', 'pct_on_time')}, {r('avg(dias_retraso)', 'mean_delay_days')},
    {r('avg(dias_entrega)', 'mean_delivery_days')}, {r('avg(total_price)', 'mean_price')},
    {r('avg(total_freight_value)', 'mean_freight')}, {r('avg(tiene_comentario) * 100', 'pct_with_comment')}
    FROM eda WHERE order_status = 'delivered'"""))
def baseline_business_metrics(spark, folder):
    return rounded(ag.business_baseline(frames.explored(spark, folder).where("order_status = 'delivered'")))


_DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _describe_sql(c: str) -> str:
    return f"""count({c}) AS n, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')}, {r(f'min({c})', 'min')},
    {r(f'quantile_cont({c}, 0.25)', 'q25')}, {r(f'quantile_cont({c}, 0.5)', 'q50')},
    {r(f'quantile_cont({c}, 0.75)', 'q75')}, {r(f'max({c})', 'max')}"""


@Q.query("describe_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_describe_sql(c)} FROM lineitem" for c in _DESCRIBED))
def describe_numeric(spark, folder):
    return rounded(ag.describe(star.table(spark, folder, "lineitem").select(*_DESCRIBED), _DESCRIBED))


@Q.query("describe_by_group", R.sql(R.EDA, f"""SELECT review_score, {_describe_sql('dias_retraso')} FROM eda
    WHERE dias_retraso IS NOT NULL AND review_score IS NOT NULL GROUP BY 1"""))
def describe_by_group(spark, folder):
    kept = frames.staged_explored(spark, folder, "dias_retraso", "review_score").dropna(subset=["dias_retraso", "review_score"])
    return rounded(ag.describe_by(kept, ["review_score"], "dias_retraso"))


@Q.query("quantile_bounds", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {r(f'quantile_cont({c}, 0.01)', 'lower')}, {r(f'quantile_cont({c}, 0.99)', 'upper')},
    {r(f'quantile_cont({c}, 0.5)', 'median')} FROM lineitem""" for c in _DESCRIBED))
def quantile_bounds(spark, folder):
    from orderpulse.operators.quantiles import exact_quantiles

    items = star.table(spark, folder, "lineitem").select(*_DESCRIBED)
    rows = [(c, q[0], q[2], q[1]) for c, q in exact_quantiles(items, _DESCRIBED, [0.01, 0.5, 0.99]).items()]
    return rounded(spark.createDataFrame(rows, "feature string, lower double, upper double, median double"))


@Q.query("mode_value", " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS feature, {c}::VARCHAR AS mode, count(*) AS n FROM part WHERE {c} IS NOT NULL
    GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1)""" for c in ("p_brand", "p_type", "p_size")))
def mode_value(spark, folder):
    return ag.modes(star.table(spark, folder, "part"), ["p_brand", "p_type", "p_size"])


@Q.query("date_range_profile", R.sql(R.ORDERS_PLAIN, """SELECT count(*) AS n,
    strftime(min(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS "first",
    strftime(max(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS "last",
    string_agg(DISTINCT year(order_purchase_timestamp)::VARCHAR, ',' ORDER BY year(order_purchase_timestamp)::VARCHAR) AS years
    FROM orders_plain"""))
def date_range_profile(spark, folder):
    return ag.date_range(star.orders_plain(star.table(spark, folder, "orders")), "order_purchase_timestamp")


_CORR = (
    "review_score", "dias_retraso", "dias_entrega", "approval_time_hours", "total_price", "total_freight_value",
    "freight_ratio", "order_item_count", "delivered_on_time", "tiene_comentario",
)


def _corr_where() -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in _CORR)


@Q.query("correlation_matrix", R.sql(R.EDA + f", k AS (SELECT * FROM eda WHERE {_corr_where()})", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 'r')} FROM k" for a, b in combinations(_CORR, 2))))
def correlation_matrix(spark, folder):
    return rounded(ag.correlations(frames.staged_explored(spark, folder, *_CORR), _CORR, drop_missing=True))


@Q.query("corr_with_target", R.sql(R.EDA, " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'corr({c}, review_score)', 'r')} FROM eda" for c in _CORR[1:])))
def corr_with_target(spark, folder):
    return rounded(ag.correlation_with(frames.staged_explored(spark, folder, *_CORR), "review_score", _CORR[1:]))


@Q.query("class_profile", R.sql(R.EDA, " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {r(f'avg({c}) FILTER (satisfecho = 0)', 'mean_0')},
    {r(f'avg({c}) FILTER (satisfecho = 1)', 'mean_1')},
    {r(f'(avg({c}) FILTER (satisfecho = 0) - avg({c}) FILTER (satisfecho = 1)) / (abs(avg({c}) FILTER (satisfecho = 1)) + 1e-9::DOUBLE) * 100', 'diff_pct')},
    {r(f'min({c})', 'min')}, {r(f'max({c})', 'max')}, {r(f'stddev_samp({c})', 'std')} FROM eda""" for c in _CORR[1:])))
def class_profile(spark, folder):
    return rounded(ag.class_profile(frames.staged_explored(spark, folder, "satisfecho", *_CORR[1:]), "satisfecho", _CORR[1:]))


# the width follows from both ends, so both engines compute it the same way
@Q.query("class_histogram", R.sql("""
    x AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS class, l_extendedprice AS v FROM lineitem),
    b AS (SELECT min(q1) AS lo, max(q99) AS hi FROM (
      SELECT quantile_cont(v, 0.01) AS q1, quantile_cont(v, 0.99) AS q99 FROM x GROUP BY class)),
    c AS (SELECT class, least(floor((v - lo) * 39 / (hi - lo))::INTEGER + 1, 39) AS bin, hi, lo FROM x, b
      WHERE v BETWEEN lo AND hi)""",
    f"""SELECT class, bin, count(*) AS n,
    {r("count(*) / (sum(count(*)) OVER (PARTITION BY class) * (any_value(hi) - any_value(lo)) / 39)", 'density', 9)}
    FROM c GROUP BY class, bin"""))
def class_histogram(spark, folder):
    items = star.table(spark, folder, "lineitem").select(
        ex.flag(F.col("l_returnflag") == "R").alias("class"), "l_extendedprice"
    )
    return rounded(ag.class_histogram(items, "class", "l_extendedprice"), 9)


@Q.query("mann_whitney_u", R.sql(R.EDA + """,
    x AS (SELECT satisfecho AS g, dias_retraso AS v FROM eda WHERE order_status = 'delivered' AND dias_retraso IS NOT NULL),
    ranked AS (SELECT g, v, rank() OVER (ORDER BY v) AS lo, count(*) OVER (PARTITION BY v) AS t FROM x),
    s AS (SELECT sum(CASE WHEN g = 1 THEN lo + (t - 1) / 2.0::DOUBLE END) AS r1, count(*) FILTER (WHERE g = 1)::DOUBLE AS n1,
      count(*) FILTER (WHERE g = 0)::DOUBLE AS n2, sum(t::DOUBLE * t - 1) AS ties FROM ranked),
    u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u, n1 + n2 AS n FROM s)""",
    # the tail by Chebyshev fitting, good to about 1e-7: another way than the query's own
    f"""SELECT {r('u', 'u', 1)}, n1::BIGINT AS n1, n2::BIGINT AS n2, {r('z', 'z')},
    {r('CASE WHEN z >= 0 THEN 1 - c / 2 ELSE c / 2 END', 'p_less')} FROM (SELECT *, t * exp(-z * z / 2 - 1.26551223
      + t * (1.00002368 + t * (0.37409196 + t * (0.09678418 + t * (-0.18628806 + t * (0.27886807
      + t * (-1.13520398 + t * (1.48851587 + t * (-0.82215223 + t * 0.17087277::DOUBLE))))))))) AS c
      FROM (SELECT *, 1 / (1 + 0.5::DOUBLE * abs(z) / sqrt(2)) AS t
        FROM (SELECT *, (u - n1 * n2 / 2 + 0.5) / sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1)))) AS z FROM u)))"""))
def mann_whitney_u(spark, folder):
    kept = frames.explored(spark, folder).where("order_status = 'delivered'")
    found = drift.mann_whitney(kept, "dias_retraso", F.col("satisfecho") == 1, F.col("satisfecho") == 0)
    return rounded(found.withColumn("u", F.round("u", 1)), 4)
