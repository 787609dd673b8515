"""Table, report and split writers plus the append-only metric history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

HISTORY_SCHEMA = "timestamp string, n_registros long, auc_roc double, accuracy double, f1_clase_0 double"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Iterable[str] = (),
) -> None:
    """Write a table; CSV gets a header and quoting that reads back unchanged."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    keys = list(partition_by)
    (writer.partitionBy(*keys) if keys else writer).save(path)


def write_splits(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet") -> None:
    """One table laid out by split, so reading one split skips the others."""
    write_table(df, path, fmt, partition_by=[split])


def read_split(spark: SparkSession, path: str, value: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split) == value).drop(split)


def features_and_label(
    df: DataFrame, label: str = "satisfecho", drop: Iterable[str] = ("order_purchase_timestamp",),
    key: str = "order_id",
) -> tuple[DataFrame, DataFrame]:
    """Feature and label projections; both carry the key instead of a row order."""
    return df.drop(label, *drop), df.select(key, label)


def write_report(df: DataFrame, path: str) -> None:
    """Append-free JSON report: one line per metric row."""
    df.write.mode("overwrite").json(path)


def verify_written(
    written: DataFrame, expected: DataFrame, split: str = "split"
) -> DataFrame:
    """Rows and missing cells per split, next to the rows that were expected."""
    cells = [F.count_if(F.col(c).isNull()) for c in written.columns if c != split]
    nulls = cells[0]
    for c in cells[1:]:
        nulls = nulls + c
    got = written.groupBy(split).agg(F.count("*").alias("rows_written"), nulls.alias("null_cells"))
    want = expected.groupBy(split).agg(F.count("*").alias("rows_expected"))
    return want.join(got, split, "full").withColumn(
        "ok",
        F.coalesce((F.col("rows_written") == F.col("rows_expected")) & (F.col("null_cells") == 0), F.lit(False)),
    )


def add_scores(labels: DataFrame, scores: DataFrame, path: str, key: str = "order_id") -> DataFrame:
    """Join a 6-digit probability to stored labels and write it as a new table."""
    joined = labels.join(
        scores.select(key, F.round("proba", 6).alias("proba_satisfecho")), key, "left"
    )
    write_table(joined, path)
    return labels.sparkSession.read.parquet(path)


def append_history(
    spark: SparkSession, path: str, metrics: DataFrame, timestamp: str | None = None
) -> DataFrame:
    """Add one metric row for a run, named by its time; metrics has n, auc, accuracy and f1_0.

    Each run is a partition of its own and replaces it, so a repeated task, or a run that is started again with its
    time, leaves one row; other runs' files are not touched.
    """
    stamp = timestamp or dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    row = metrics.select(
        F.lit(stamp).alias("timestamp"),
        F.col("n").cast("long").alias("n_registros"),
        F.col("auc").cast("double").alias("auc_roc"),
        F.col("accuracy").cast("double").alias("accuracy"),
        F.col("f1_0").cast("double").alias("f1_clase_0"),
        F.sha2(F.lit(stamp), 256).alias("run_id"),
    )
    # one run adds one row; a single small file per run keeps the folder readable
    writer = row.coalesce(1).write.mode("overwrite").partitionBy("run_id")
    writer.option("partitionOverwriteMode", "dynamic").json(path)
    return read_history(spark, path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    columns = T.StructType.fromDDL(HISTORY_SCHEMA).names
    try:
        return spark.read.schema(HISTORY_SCHEMA + ", run_id string").json(path).select(*columns)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], HISTORY_SCHEMA)


def history_trend(history: DataFrame) -> DataFrame:
    """Metrics in run order; empty until at least two runs exist.

    One row per run, so the unpartitioned window stays tiny.
    """
    runs = F.count("*").over(W.partitionBy())
    run = F.row_number().over(W.orderBy("timestamp"))
    return (
        history.select(
            "timestamp", run.cast("int").alias("run"), runs.alias("_runs"),
            "n_registros", "auc_roc", "accuracy", "f1_clase_0",
        )
        .where("_runs >= 2")
        .drop("_runs")
    )
