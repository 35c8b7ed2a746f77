"""The shared folder of the cluster, for checkpoints, streams and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under `spark.checkpoint.dir`.

    Only a local session, where driver and executors are one machine, may go without
    that setting.
    """
    base = spark.conf.get(CONF, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"Set {CONF} to a folder that all executors share")
        base = tempfile.gettempdir() + "/chronoloom"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoint"))
    return df.checkpoint(eager=True)
