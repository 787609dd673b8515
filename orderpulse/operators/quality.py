"""Profiles, missing-value reports, invariants and cleaning steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Row, functions as F, types as T

from orderpulse.functions import expressions as ex
from orderpulse.operators.arrays import per_column
from orderpulse.operators.quantiles import exact_quantiles
from orderpulse.sources.staging import stage

# Column groups that cleaning removes, the categories it buckets
# and the fill texts.
DROP_GROUPS: dict[str, list[str]] = {
    "ids": ["customer_id", "seller_id", "product_id"],
    "fechas": [
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date", "purchase_year_month",
    ],
    "leakage": [
        "review_score", "review_comment_message", "review_comment_title", "has_comment",
        "has_review_title", "comment_length",
    ],
    "duplicadas": ["uses_installments", "customer_city", "seller_city"],
}
CATEGORY_COLUMNS = (
    "product_category_name_english", "customer_state", "seller_state", "payment_type", "customer_region",
)
PARALLELISM = 4  # tables profiled side by side
UNKNOWN_TEXT = "desconocido"
OTHER_TEXT = "otros"


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, missing cells, columns with missing cells and exact duplicates.

    Cells are counted in one scan without a shuffle; see :func:`repeats` for the duplicates.
    """
    missing = [F.count_if(F.col(c).isNull()) for c in df.columns]
    add = lambda a, b: a + b
    counts = df.agg(
        F.count("*").alias("filas"),
        reduce(add, missing).alias("nulos_total"),
        reduce(add, [ex.flag(m > 0) for m in missing]).alias("columnas_con_nulos"),
    )
    return counts.select(
        F.lit(name).alias("tabla"), "filas", F.lit(len(df.columns)).alias("columnas"), "nulos_total",
        "columnas_con_nulos", repeats(df).scalar().alias("duplicados"),
    )


def repeats(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier identical row; missing cells are equal.

    Two hashes of each row are shuffled instead of the row.  Only rows whose
    hashes occur twice are compared in full, column by column.
    """
    gone = [F.col(c).isNull() for c in df.columns]
    marked = df.withColumns(
        {"_h1": F.xxhash64(*df.columns), "_h2": F.xxhash64(*gone, *reversed(df.columns))}
    )
    # written, so that the size of the join's small side is known
    shared = stage(marked.groupBy("_h1", "_h2").count().where("count > 1").select("_h1", "_h2"), "shared")
    groups = marked.join(shared, ["_h1", "_h2"], "left_semi").groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def profile_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    # the hashes that repeat are written per table: side by side
    with ThreadPoolExecutor(PARALLELISM) as pool:
        profiles = list(pool.map(lambda item: table_profile(item[1], item[0]), tables.items()))
    return reduce(lambda a, b: a.unionByName(b), profiles)


def quality_alerts(profiles: DataFrame) -> DataFrame:
    """Status (OK or REVISAR) and alert text per profiled table."""
    parts = F.concat_ws(
        " | ",
        F.when(F.col("duplicados") > 0, F.concat(F.col("duplicados").cast("string"), F.lit(" duplicados"))),
        F.when(F.col("nulos_total") > 0, F.concat(F.col("nulos_total").cast("string"), F.lit(" nulos"))),
    )
    return profiles.select(
        "tabla", F.when(parts == "", "OK").otherwise("REVISAR").alias("estado"), parts.alias("alertas")
    )


def profile_summary(profiles: DataFrame, expected: int) -> DataFrame:
    """Totals over all profiled tables and whether every expected table loaded."""
    clean = (F.col("nulos_total") == 0) & (F.col("duplicados") == 0)
    return profiles.agg(
        F.count("*").alias("tablas_cargadas"),
        F.lit(expected).alias("tablas_esperadas"),
        F.count_if(clean).alias("tablas_limpias"),
        F.coalesce(F.sum("filas"), F.lit(0)).alias("total_filas"),
        F.coalesce(F.sum("nulos_total"), F.lit(0)).alias("total_nulos"),
        F.coalesce(F.sum("duplicados"), F.lit(0)).alias("total_duplicados"),
        F.when(F.count("*") == expected, "OK").otherwise("INCOMPLETO").alias("estado_general"),
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, and rows that repeat an earlier identical row."""
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", repeats(df).scalar().alias("duplicates"))


def missing_report(df: DataFrame, all_columns: bool = False) -> DataFrame:
    """Missing cells and percent per column; only columns that miss any."""
    n = F.count("*")
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c).isNull()).alias("missing"),
            (F.count_if(F.col(c).isNull()) / F.nullif(n.cast("double"), F.lit(0.0)) * 100).alias("pct"),
        )
        for c in df.columns
    ]
    out = df.agg(F.array(*rows).alias("m")).select(F.inline("m"))
    return out if all_columns else out.where("missing > 0")


def missing_shares(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float]:
    """Missing share per column (one small row to the driver)."""
    names = list(columns or df.columns)
    row = df.agg(*[F.avg(ex.flag(F.col(c).isNull()).cast("double")).alias(f"c{i}") for i, c in enumerate(names)]).first()
    return {c: row[i] or 0.0 for i, c in enumerate(names)}


def schema_listing(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table, ordinal, column, type and missing cells of every column."""
    parts = []
    for name, df in tables.items():
        rows = [
            F.struct(
                F.lit(i).alias("ordinal"), F.lit(f.name).alias("columna"),
                F.lit(f.dataType.simpleString()).alias("tipo"), F.count_if(F.col(f.name).isNull()).alias("nulos"),
            )
            for i, f in enumerate(df.schema.fields, 1)
        ]
        parts.append(df.agg(F.array(*rows).alias("m")).select(F.lit(name).alias("tabla"), F.inline("m")))
    return reduce(lambda x, y: x.unionByName(y), parts)


def stage_report(df: DataFrame, stage: str, table: str, label: str | None = None) -> DataFrame:
    """Long-form report of a stage: shape, missing cells per column, label balance."""
    cell = lambda column, metric, value: F.struct(
        F.lit(column).cast("string").alias("column"), F.lit(metric).alias("metric"), value.cast("double").alias("value")
    )
    rows = [cell(None, "rows", F.count("*")), cell(None, "columns", F.lit(len(df.columns)))]
    rows += [cell(c, "missing", F.count_if(F.col(c).isNull())) for c in df.columns]
    if label:
        rows += [
            cell(label, "positive", F.count_if(F.col(label) == 1)),
            cell(label, "negative", F.count_if(F.col(label) == 0)),
            cell(label, "rate", F.avg(F.col(label).cast("double"))),
        ]
    long = df.agg(F.array(*rows).alias("m")).select(
        F.lit(stage).alias("stage"), F.lit(table).alias("table"), F.inline("m")
    )
    return long.where("metric <> 'missing' OR value > 0")


def first_rows(df: DataFrame, key: Sequence[str], n: int = 2) -> DataFrame:
    return df.orderBy(*key).limit(n)


def drop_listed(df: DataFrame, groups: Mapping[str, Sequence[str]] = DROP_GROUPS) -> tuple[DataFrame, DataFrame]:
    """Drop the listed columns the frame has; log each name as dropped or absent."""
    rows = [
        Row(column_group=g, column_name=c, dropped=int(c in df.columns)) for g, cols in groups.items() for c in cols
    ]
    log = df.sparkSession.createDataFrame(rows, "column_group string, column_name string, dropped int")
    return df.drop(*[r.column_name for r in rows if r.dropped]), log


def missing_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Row count, and missing cells of the columns that miss any."""
    told = per_column(df, [F.lit(True), *[F.col(c).isNull() for c in df.columns]], F.count_if("v").alias("n"))
    counts = {i: r["n"] for i, r in told.items()}
    return counts.get(0, 0), {c: counts[i] for i, c in enumerate(df.columns, 1) if counts.get(i)}


def sparse_columns(df: DataFrame, threshold: float = 0.15, counts: tuple[int, dict[str, int]] | None = None) -> dict[str, float]:
    """Columns whose missing share exceeds the threshold."""
    n, missing = counts or missing_counts(df)
    return {c: m / n for c, m in missing.items() if m / n > threshold}


def drop_sparse(df: DataFrame, threshold: float = 0.15) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def fit_imputation(
    df: DataFrame, text_fill: str | None = UNKNOWN_TEXT, no_mode: str = "Unknown",
    missing: Mapping[str, int] | None = None,
) -> dict[str, dict[str, object]]:
    """Fill value per column with missing cells.

    Numbers get the median; text gets a constant, or the most frequent value
    when ``text_fill`` is None.  Known missing counts save a pass.
    """
    from orderpulse.operators.aggregates import modes

    types = _types(df)
    missing = missing_counts(df)[1] if missing is None else {c: m for c, m in missing.items() if c in types}
    numbers = [c for c in missing if ex.is_numeric(types[c])]
    texts = [c for c in missing if isinstance(types[c], T.StringType)]
    fills: dict[str, dict[str, object]] = {}
    for c, q in exact_quantiles(df, numbers, [0.5]).items():
        if q[0] is not None:
            fills[c] = {"tipo": "mediana", "valor": q[0], "nulos_imputados": missing[c]}
    common: dict[str, str] = {}
    if texts and text_fill is None:
        # one row per column
        common = {row["feature"]: row["mode"] for row in modes(df, texts).collect()}
    for c in texts:
        kind = "constante" if text_fill is not None else "moda"
        value = text_fill if text_fill is not None else common.get(c, no_mode)
        fills[c] = {"tipo": kind, "valor": value, "nulos_imputados": missing[c]}
    return fills


def apply_imputation(df: DataFrame, fills: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Fill missing cells; imputed number columns become double (medians may be halves)."""
    changes = {
        c: F.coalesce(F.col(c).cast("double") if f["tipo"] == "mediana" else F.col(c), F.lit(f["valor"]))
        for c, f in fills.items()
    }
    return df.withColumns(changes) if changes else df


def imputation_log(df: DataFrame, fills: Mapping[str, Mapping[str, object]], digits: int = 4) -> DataFrame:
    rows = [
        Row(
            column=c, tipo=f["tipo"],
            valor=f"{f['valor']:.{digits}f}" if f["tipo"] == "mediana" else str(f["valor"]),
            nulos_imputados=int(f["nulos_imputados"]),
        )
        for c, f in fills.items()
    ]
    return df.sparkSession.createDataFrame(rows, "column string, tipo string, valor string, nulos_imputados long")


def impute(df: DataFrame, text_fill: str = UNKNOWN_TEXT, fit_on: DataFrame | None = None) -> DataFrame:
    return apply_imputation(df, fit_imputation(fit_on if fit_on is not None else df, text_fill))


def repair(df: DataFrame, date: str) -> DataFrame:
    """Second-chance fill: undated rows go, numbers get medians, text gets modes."""
    dated = df.where(F.col(date).isNotNull())
    return apply_imputation(dated, fit_imputation(dated, text_fill=None))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count per (column, category) over all listed columns in one scan."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in columns])
    )
    return (
        df.select(pairs.alias("p"))
        .where("p.category IS NOT NULL")
        .groupBy(F.col("p.column").alias("column"), F.col("p.category").alias("category"))
        .agg(F.count("*").alias("n"))
    )


def _with_share(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("column").agg(F.sum("n").cast("double").alias("total"))
    return counts.join(totals, "column").withColumn("share", F.col("n") / F.col("total"))


def bucket_rare(
    df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS, threshold: float = 0.01, other: str = OTHER_TEXT
) -> DataFrame:
    """Replace categories below the share threshold by one bucket.

    Only the frequent categories travel to the driver: at most 1/threshold per
    column, however many rare ones there are.
    """
    if threshold <= 0:
        raise ValueError("the share threshold must be above 0")
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    kept: dict[str, list[str]] = {c: [] for c in present}
    for row in _with_share(category_counts(df, present)).where(F.col("share") >= threshold).collect():
        kept[row["column"]].append(row["category"])
    return df.withColumns(
        {
            c: F.when(F.col(c).isNull() | F.col(c).isin(kept[c]), F.col(c)).otherwise(F.lit(other))
            for c in present
        }
    )


def rare_log(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Rare categories and remaining cardinality per column that has any rare one."""
    rare = F.col("share") < threshold
    return (
        _with_share(category_counts(df, [c for c in columns if c in df.columns]))
        .groupBy("column")
        .agg(
            F.count_if(rare).alias("categorias_agrupadas"),
            (F.count_if(~rare) + F.max(ex.flag(rare))).alias("cardinalidad_final"),
        )
        .where("categorias_agrupadas > 0")
    )


def invariants(
    df: DataFrame, label: str = "satisfecho", leakage: Sequence[str] = tuple(DROP_GROUPS["leakage"])
) -> DataFrame:
    """Violations per check: missing cells, labels outside 0/1, leaked columns."""
    # added up within a row: an aggregate per column makes a function too long to compile
    missing = reduce(lambda a, b: a + b, [ex.flag(F.col(c).isNull()) for c in df.columns])
    cells = F.coalesce(F.sum(missing.cast("long")), F.lit(0).cast("long"))
    bad = F.count_if(~F.col(label).isin(0, 1)) if label in df.columns else F.lit(-1).cast("long")
    leaked = [c for c in leakage if c in df.columns]
    rows = [
        F.struct(F.lit("missing_cells").alias("check"), cells.alias("violations")),
        F.struct(F.lit("label_domain").alias("check"), bad.alias("violations")),
        F.struct(F.lit("leakage_columns").alias("check"), F.lit(len(leaked)).cast("long").alias("violations")),
    ]
    return df.agg(F.array(*rows).alias("m")).select(F.inline("m"))


def require_invariants(df: DataFrame, label: str = "satisfecho") -> DataFrame:
    """Raise with the failing checks and the columns that miss values."""
    failed = {r["check"]: r["violations"] for r in invariants(df, label).collect() if r["violations"]}
    if failed:
        columns = sorted(missing_counts(df)[1])
        raise ValueError(f"invariants violated: {failed}; columns with missing cells: {columns}")
    return df
