"""Streaming de-duplication, resampling, sessions and model updates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.steps import Step, ticks
from chronoloom.shared import shared_dir

# State lives in RocksDB on disk, so it is not bounded by executor memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(
    spark: SparkSession, path: str, glob: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of parquet files as a stream, with the schema of the files there now."""
    folder = spark.read
    reader = spark.readStream
    if glob:
        folder, reader = folder.option("pathGlobFilter", glob), reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.schema(folder.parquet(path).schema).parquet(path)


def event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark on `column`; TIMESTAMP_NTZ becomes TIMESTAMP, which watermarks need."""
    if isinstance(stream.schema[column].dataType, T.TimestampNTZType):
        stream = stream.withColumn(column, F.col(column).cast("timestamp"))
    return stream.withWatermark(column, delay)


def dedupe_stream(stream: DataFrame, keys: Iterable[str], time: str, delay: str) -> DataFrame:
    """First arrival per (key, time); rows later than the watermark are dropped."""
    return event_time(stream, time, delay).dropDuplicatesWithinWatermark([*keys, time])


def resample_stream(
    stream: DataFrame, keys: Iterable[str], time: str, value: str, every: str, delay: str,
    slide: str | None = None,
) -> DataFrame:
    """Count and sum per key and window; a window is emitted once it is closed."""
    w = F.window(time, every, slide) if slide else F.window(time, every)
    return (
        event_time(stream, time, delay)
        .groupBy(*keys, w.alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(*keys, F.col("w.start").alias("ts"), "n", "total")
    )


def session_stream(
    stream: DataFrame, keys: Iterable[str], time: str, value: str, gap: str, delay: str
) -> DataFrame:
    """Sessions per key that end after `gap` without a row.

    Rows of a key are merged into sessions on the map side first, so that a crowded key
    sends sessions instead of rows.
    """
    stream.sparkSession.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
    )
    return (
        event_time(stream, time, delay)
        .groupBy(*keys, F.session_window(time, gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")
    )


def model_stream(
    stream: DataFrame, keys: Iterable[str], time: str, value: str, sp: int = 1, freq: str = "D"
) -> DataFrame:
    """Model state per key and season slot: count, sum, and the latest value.

    These are the mergeable parts of the mean, seasonal mean, last and seasonal last
    forecasters. As a plain streaming aggregate, every micro-batch is combined on the
    map side before the shuffle, so a crowded key costs one row per task.
    """
    step = Step.parse(freq)
    if step.months:
        raise ValueError("Season slots on a stream need a fixed step")
    if isinstance(stream.schema[time].dataType, T.TimestampNTZType):
        stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    dtype = stream.schema[time].dataType
    slot = F.pmod(F.call_function("div", ticks(F.col(time), dtype), F.lit(step.ticks)), F.lit(sp))
    return (
        stream.groupBy(*keys, slot.cast("int").alias("slot"))
        .agg(
            F.count(value).alias("n"),
            F.sum(value).alias("total"),
            F.max(F.struct(F.col(time).alias("ts"), F.col(value).alias("y"))).alias("m"),
        )
        .select(*keys, "slot", "n", "total", F.col("m.ts").alias("last_ts"), F.col("m.y").alias("last"))
    )


def run_append(stream: DataFrame, name: str) -> DataFrame:
    """Drain the available input into parquet in the shared folder and read it back.

    State, offsets and results are all on shared storage, so a lost executor only
    repeats its tasks.
    """
    spark = stream.sparkSession
    base = shared_dir(spark, name)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{base}/out").option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def run_update(stream: DataFrame, keys: Iterable[str], name: str) -> DataFrame:
    """Drain an update-mode stream; the result is the latest version of each row.

    Every batch writes its changed rows under its own number, which makes a repeated
    batch overwrite itself. Readers take the highest batch per key.
    """
    spark = stream.sparkSession
    base, keys = shared_dir(spark, name), list(keys)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    query = (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rest = [c for c in stream.columns if c not in keys]
    rows = spark.read.parquet(f"{base}/out")
    latest = rows.groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("r"))
    return latest.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])
