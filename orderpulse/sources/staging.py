"""Written intermediate tables in the cluster's shared checkpoint folder.

A staged table cuts lineage: later jobs read files that survive executor loss
instead of recomputing a long plan, and they read only the columns they need.
"""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else by ``SparkContext.setCheckpointDir``.

    Only a master within this process may fall back to a scratch folder of this
    machine; on a cluster, ``local-cluster`` included, a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_scratch()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="orderpulse-")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the frame as Parquet under the shared folder and read it back."""
    spark = df.sparkSession
    app = spark.conf.get("spark.app.id", "app")
    path = f"{shared_folder(spark)}/{app}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
