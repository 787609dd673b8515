"""Profiling and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderpulse.operators import quality as qa
from orderpulse.registry import Registry, frames, r, roles_sql as R, rounded
from orderpulse.registry.orders import MASTER_COLUMNS, MASTER_DATES, MASTER_NUMBERS, MASTER_TEXTS
from orderpulse.sources import star

Q = Registry()

# Column names and types of the test tables.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _profile_sql(name: str) -> str:
    cols = [column.split(" ")[0] for column in _SCHEMAS[name].split(", ")]
    nulls = [f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols]
    return f"""SELECT '{name}' AS tabla, count(*) AS filas, {len(cols)} AS columnas,
      ({' + '.join(nulls)})::BIGINT AS nulos_total,
      {' + '.join(f'(CASE WHEN {n} > 0 THEN 1 ELSE 0 END)' for n in nulls)} AS columnas_con_nulos,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {name})) AS duplicados
      FROM {name}"""


_PROFILES = "profiles AS (" + " UNION ALL ".join(map(_profile_sql, _SCHEMAS)) + ")"


def _profiles(spark, folder):
    """Profiles of all tables, over every column."""
    return qa.profile_all(star.catalog(spark, folder))


@Q.query("table_profile", R.sql(_PROFILES, "SELECT * FROM profiles"))
def table_profile(spark, folder):
    return _profiles(spark, folder)


@Q.query("quality_alerts", R.sql(_PROFILES, """SELECT tabla,
    CASE WHEN duplicados > 0 OR nulos_total > 0 THEN 'REVISAR' ELSE 'OK' END AS estado,
    concat_ws(' | ', CASE WHEN duplicados > 0 THEN duplicados || ' duplicados' END,
      CASE WHEN nulos_total > 0 THEN nulos_total || ' nulos' END) AS alertas FROM profiles"""))
def quality_alerts(spark, folder):
    return qa.quality_alerts(_profiles(spark, folder))


@Q.query("quality_summary", R.sql(_PROFILES, f"""SELECT count(*) AS tablas_cargadas, {len(_SCHEMAS)} AS tablas_esperadas,
    count(*) FILTER (WHERE nulos_total = 0 AND duplicados = 0) AS tablas_limpias, sum(filas)::BIGINT AS total_filas,
    sum(nulos_total)::BIGINT AS total_nulos, sum(duplicados)::BIGINT AS total_duplicados,
    CASE WHEN count(*) = {len(_SCHEMAS)} THEN 'OK' ELSE 'INCOMPLETO' END AS estado_general FROM profiles"""))
def quality_summary(spark, folder):
    return qa.profile_summary(_profiles(spark, folder), expected=len(_SCHEMAS))


@Q.query("missing_report", R.sql(R.MASTER, "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing, {r(f'count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100', 'pct')}
    FROM master""" for c in MASTER_COLUMNS) + ") WHERE missing > 0"))
def missing_report(spark, folder):
    return rounded(qa.missing_report(frames.features(spark, folder)))


def _listing_sql() -> str:
    parts = []
    for t, columns in _SCHEMAS.items():
        for i, column in enumerate(columns.split(", "), 1):
            name, kind = column.split(" ")
            parts.append(
                f"SELECT '{t}' AS tabla, {i} AS ordinal, '{name}' AS columna, '{kind}' AS tipo, "
                f"count(*) - count({name}) AS nulos FROM {t}"
            )
    return " UNION ALL ".join(parts)


@Q.query("schema_listing", _listing_sql())
def schema_listing(spark, folder):
    return qa.schema_listing(star.catalog(spark, folder))


@Q.query("stage_report", R.sql(R.MASTER, f"""SELECT 'features' AS stage, 'master' AS "table", * FROM (
    SELECT NULL::VARCHAR AS "column", 'rows' AS metric, count(*)::DOUBLE AS value FROM master
    UNION ALL SELECT NULL, 'columns', {len(MASTER_COLUMNS)}
    {' '.join(f"UNION ALL SELECT '{c}', 'missing', (count(*) - count({c}))::DOUBLE FROM master" for c in MASTER_COLUMNS)}
    UNION ALL SELECT 'satisfecho', 'positive', sum(satisfecho)::DOUBLE FROM master
    UNION ALL SELECT 'satisfecho', 'negative', sum(1 - satisfecho)::DOUBLE FROM master
    UNION ALL SELECT 'satisfecho', 'rate', round(avg(satisfecho), 4) FROM master)
    WHERE metric <> 'missing' OR value > 0"""))
def stage_report(spark, folder):
    return rounded(qa.stage_report(frames.features(spark, folder), "features", "master", "satisfecho"))


@Q.query("first_rows", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 2")
def first_rows(spark, folder):
    orders = star.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return qa.first_rows(orders, ["o_orderkey"])


@Q.query("drop_sparse_columns", R.sql(R.MASTER, " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {r(f'count(*) FILTER (WHERE {c} IS NULL) / count(*)', 'share')},
    count(*) FILTER (WHERE {c} IS NULL) / count(*) > 0.15 AS dropped FROM master""" for c in MASTER_COLUMNS)))
def drop_sparse_columns(spark, folder):
    df = frames.staged_features(spark, folder)
    kept = qa.drop_sparse(df).columns
    shares = qa.missing_shares(df)
    rows = [(c, shares[c], c not in kept) for c in MASTER_COLUMNS]
    return rounded(spark.createDataFrame(rows, "`column` string, share double, dropped boolean"))


_FILLS = R.MASTER + f""",
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in MASTER_NUMBERS)} FROM master)"""


def _numbers_filled(df):
    return rounded(df.withColumns({c: F.col(c).cast("double") for c in MASTER_NUMBERS}).drop(*MASTER_DATES), 7)


@Q.query("impute", R.sql(_FILLS, f"""SELECT {', '.join(r(f'coalesce({c}, m_{c})', c, 7) for c in MASTER_NUMBERS)},
    {', '.join(f"coalesce({c}, 'desconocido') AS {c}" for c in MASTER_TEXTS)} FROM master, med"""))
def impute(spark, folder):
    """Every column of the master; dates stay as they are and are left out of the result."""
    return _numbers_filled(qa.impute(frames.staged_features(spark, folder)))


#: Money has four digits at most and half a sum of two amounts five: with six, the order of addition cannot turn the last.
LOG_DIGITS = 6


@Q.query("impute_log", R.sql(R.MASTER, "SELECT * FROM (" + " UNION ALL ".join(
    [f"""SELECT '{c}' AS "column", 'mediana' AS tipo, printf('%.{LOG_DIGITS}f', quantile_cont({c}, 0.5)::DOUBLE) AS valor,
     count(*) FILTER (WHERE {c} IS NULL) AS nulos_imputados FROM master""" for c in MASTER_NUMBERS]
    + [f"""SELECT '{c}', 'constante', 'desconocido', count(*) FILTER (WHERE {c} IS NULL) FROM master""" for c in MASTER_TEXTS]
) + ") WHERE nulos_imputados > 0"))
def impute_log(spark, folder):
    df = frames.staged_features(spark, folder)
    return qa.imputation_log(df, qa.fit_imputation(df), LOG_DIGITS)


@Q.query("impute_mode", R.sql(R.MASTER + f""",
    dated AS MATERIALIZED (SELECT * FROM master WHERE order_delivered_customer_date IS NOT NULL),
    med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in MASTER_NUMBERS)} FROM dated)""",
    f"""SELECT {', '.join(r(f'coalesce({c}, m_{c})', c, 7) for c in MASTER_NUMBERS)}, {', '.join(
    f'''coalesce({c}, (SELECT {c} FROM dated WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1),
    'Unknown') AS {c}''' for c in MASTER_TEXTS)} FROM dated, med"""))
def impute_mode(spark, folder):
    return _numbers_filled(qa.repair(frames.staged_features(spark, folder), "order_delivered_customer_date"))


# a threshold that splits 25 near-even categories
_RARE = 0.04
_RARE_COLUMNS = ("p_brand", "p_type")


def _rare_sql(c: str) -> str:
    return f"""(SELECT {c} AS v FROM part WHERE {c} IS NOT NULL GROUP BY 1
      HAVING count(*) / (SELECT count({c}) FROM part)::DOUBLE < {_RARE}::DOUBLE)"""


@Q.query("rare_bucket", f"""SELECT p_partkey, {', '.join(
    f"CASE WHEN {c} IN {_rare_sql(c)} THEN 'otros' ELSE {c} END AS {c}" for c in _RARE_COLUMNS)} FROM part""")
def rare_bucket(spark, folder):
    part = star.table(spark, folder, "part").select("p_partkey", *_RARE_COLUMNS)
    return qa.bucket_rare(part, _RARE_COLUMNS, _RARE)


@Q.query("rare_log", "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS categorias_agrupadas,
    (SELECT count(DISTINCT {c}) FROM part) - count(*) + 1 AS cardinalidad_final FROM {_rare_sql(c)}"""
    for c in _RARE_COLUMNS) + ") WHERE categorias_agrupadas > 0")
def rare_log(spark, folder):
    return qa.rare_log(star.table(spark, folder, "part"), _RARE_COLUMNS, _RARE)


@Q.query("invariant_check", R.sql(R.MASTER, f"""
    SELECT 'missing_cells' AS "check", ({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in MASTER_COLUMNS)})::BIGINT AS violations FROM master
    UNION ALL SELECT 'label_domain', count(*) FILTER (WHERE satisfecho NOT IN (0, 1)) FROM master
    UNION ALL SELECT 'leakage_columns', {len(set(qa.DROP_GROUPS['leakage']) & set(MASTER_COLUMNS))}"""))
def invariant_check(spark, folder):
    return qa.invariants(frames.features(spark, folder))
