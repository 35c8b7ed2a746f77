"""Events as a stream. The SQL twins cover what a drained stream has emitted."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.plans.registry import query, rounded
from chronoloom.streaming.ops import (
    dedupe_stream, file_stream, model_stream, resample_stream, run_append, run_update, session_stream,
)

DELAY = "1 hour"
# Windows close when the watermark, an hour behind the last event, passes their end.
_MARK = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def _events(spark, sf_dir):
    return file_stream(spark, sf_dir, "events.parquet")


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_dedupe(spark, sf_dir):
    out = run_append(dedupe_stream(_events(spark, sf_dir), ["user_id"], "ts", DELAY), "dedupe")
    return _ntz(out, "ts")


@query("SELECT DISTINCT user_id, event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts FROM events")
def stream_dedupe_days(spark, sf_dir):
    # Times cut to the day repeat for a user.
    days = _events(spark, sf_dir).select("user_id", "event_type", F.date_trunc("day", "ts").alias("ts"))
    return _ntz(run_append(dedupe_stream(days, ["user_id", "event_type"], "ts", DELAY), "dedupe"), "ts")


@query(
    f"""SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, count(*) AS n, round(sum(value), 6) AS total
        FROM events GROUP BY 1, 2 HAVING CAST(date_trunc('day', any_value(events.ts)) AS TIMESTAMP) + INTERVAL 1 DAY <= {_MARK}"""
)
def stream_tumbling(spark, sf_dir):
    daily = resample_stream(_events(spark, sf_dir), ["event_type"], "ts", "value", "1 day", DELAY)
    return rounded(_ntz(run_append(daily, "tumbling"), "ts"), "total")


@query(
    f"""WITH s AS (SELECT event_type, value, unnest([time_bucket(INTERVAL 12 HOUR, ts),
                     time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS start FROM events)
        SELECT event_type, start AS ts, count(*) AS n, round(sum(value), 6) AS total FROM s
        GROUP BY 1, 2 HAVING start + INTERVAL 1 DAY <= {_MARK}"""
)
def stream_sliding(spark, sf_dir):
    sliding = resample_stream(
        _events(spark, sf_dir), ["event_type"], "ts", "value", "1 day", DELAY, slide="12 hours"
    )
    return rounded(_ntz(run_append(sliding, "sliding"), "ts"), "total")


@query(
    f"""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g),
        t AS (SELECT user_id, sid, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n,
                     round(sum(value), 6) AS total FROM s GROUP BY 1, 2)
        SELECT user_id, start, "end", n, total FROM t WHERE "end" <= {_MARK}"""
)
def stream_session(spark, sf_dir):
    sessions = session_stream(_events(spark, sf_dir), ["user_id"], "ts", "value", "6 hours", DELAY)
    return rounded(_ntz(run_append(sessions, "session"), "start", "end"), "total")


@query(
    """SELECT user_id, CAST((epoch_us(ts) // 86400000000) % 7 AS INTEGER) AS slot, count(value) AS n,
              round(sum(value), 6) AS total, max(ts) AS last_ts, max_by(value, ts) AS last
       FROM events GROUP BY 1, 2"""
)
def stream_model_update(spark, sf_dir):
    state = model_stream(_events(spark, sf_dir), ["user_id"], "ts", "value", sp=7, freq="D")
    return rounded(_ntz(run_update(state, ["user_id", "slot"], "model"), "last_ts"), "total")
