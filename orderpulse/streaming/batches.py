"""Score labelled batches as their files arrive.

The analytics handle new data batch by batch; here each run picks up the files
that are new since the last one, scores them and adds one history row per
batch.  Replaying a batch after a failure overwrites its own output only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from orderpulse.operators import learners as ln, metrics as mt

BATCH = "batch_id"


def score_new_batches(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    model: ln.Fitted,
    output: str,
    checkpoint: str,
    label: str = "satisfecho",
    key: str = "order_id",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start a run over all files not scored yet; it ends when they are done."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(source)

    def handle(batch: DataFrame, batch_id: int) -> None:
        scored = model.score(batch.select(key, F.col(label).alias("label"), *model.features)).select(
            key, "label", "proba"
        )
        target = f"{output}/scores/{BATCH}={batch_id}"
        scored.write.mode("overwrite").parquet(target)
        done = batch.sparkSession.read.parquet(target)
        row = mt.all_metrics(done, []).select("n", "auc", "accuracy", "f1_0")
        row.coalesce(1).write.mode("overwrite").parquet(f"{output}/history/{BATCH}={batch_id}")

    return (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_history(spark: SparkSession, output: str) -> DataFrame:
    """Metric rows of all scored batches in arrival order."""
    return spark.read.parquet(f"{output}/history").orderBy(BATCH)
