"""Session settings that suit these jobs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", memory: str = "12g") -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use its own session."""
    parts = str(cpus if cpus != "*" else os.cpu_count() or 8)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("chronoloom")
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    spark = (
        builder.config("spark.sql.shuffle.partitions", parts)
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
