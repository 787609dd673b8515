"""Session helper for tests, the bench and notebooks.

Operators never depend on these settings: they run unchanged on any session a
cluster hands in.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "orderpulse", cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ORDERPULSE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        # a local run shares its folder with itself; clusters name a shared one
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orderpulse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
