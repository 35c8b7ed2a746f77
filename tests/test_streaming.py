"""Streams against the same step on a finished table."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronoloom.streaming.ops import (
    dedupe_stream, file_stream, model_stream, resample_stream, run_append, run_update, session_stream,
)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three files, one micro-batch each; the last brings rows that repeat or come late."""
    path = str(tmp_path_factory.mktemp("stream"))
    start = datetime(2024, 1, 1)
    rows = [(f"k{i % 3}", start + timedelta(minutes=20 * i), float(i)) for i in range(300)]
    late = [("k0", start, 999.0), ("k1", rows[-1][1] - timedelta(minutes=20), 5.0)]
    for i, part in enumerate((rows[:150], rows[150:], late)):
        df = spark.createDataFrame(part, "k string, ts timestamp_ntz, v double")
        df.coalesce(1).write.mode("append").parquet(path)
        del i
    return path, rows


def stream(spark, path):
    return file_stream(spark, path, files_per_trigger=1)


def test_late_rows_are_dropped_and_repeats_merged(spark, folder):
    path, rows = folder
    out = run_append(dedupe_stream(stream(spark, path), ["k"], "ts", "1 hour"), "t-dedupe")
    assert out.count() in (300, 301) and out.groupBy("k", "ts").count().where("count > 1").count() == 0


def test_closed_windows_equal_batch(spark, folder):
    path, rows = folder
    out = run_append(resample_stream(stream(spark, path), ["k"], "ts", "v", "6 hours", "1 hour"), "t-window")
    got = {(r["k"], r["ts"]): (r["n"], r["total"]) for r in out.collect()}
    want = {}
    for k, ts, v in rows:
        at = ts.replace(hour=ts.hour // 6 * 6, minute=0)
        n, total = want.get((k, at), (0, 0.0))
        want[(k, at)] = (n + 1, total + v)
    last = max(at for _, at in want)
    closed = {key: v for key, v in want.items() if key[1] < last - timedelta(hours=6)}
    assert closed and all(got[key] == v for key, v in closed.items())


def test_sessions(spark, folder):
    path, _ = folder
    out = run_append(session_stream(stream(spark, path), ["k"], "ts", "v", "30 minutes", "1 hour"), "t-session")
    # Rows of a key are an hour apart, so each one is a session.
    assert out.where("n = 1").count() == out.count() > 200


def test_model_equals_batch(spark, folder):
    path, _ = folder
    out = run_update(model_stream(stream(spark, path), ["k"], "ts", "v", 2, "D"), ["k", "slot"], "t-model")
    batch = spark.read.parquet(path)
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
    want = batch.groupBy("k", (day % 2).alias("slot")).agg(
        F.count("v").alias("n"), F.sum("v").alias("total"), F.max(F.struct("ts", "v"))["v"].alias("last")
    )
    key = ["k", "slot", "n", "total", "last"]
    assert sorted(map(tuple, out.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))
