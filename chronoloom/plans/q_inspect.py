"""Inspection and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.frame import with_roles
from chronoloom.operators.clean import regular_grid
from chronoloom.operators.inspect import (
    constants, describe, extent, frequency_label, is_valid, missing, structure, validate,
)
from chronoloom.plans.panels import BY_PRIORITY, BY_STATUS, BY_USER, by_priority, by_status, by_user
from chronoloom.plans.registry import flag, query, rounded
from chronoloom.sources.datasets import table

_GRID = f"""{BY_USER}, b AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM by_user GROUP BY 1),
  g AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM b),
  r AS (SELECT g.user_id, g.ts, u.y FROM g LEFT JOIN by_user u USING (user_id, ts))"""


@query(
    f"""WITH {BY_USER} SELECT user_id, count(y) AS count, round(avg(y), 6) AS mean,
        round(stddev_samp(y), 6) AS std, min(y) AS min, round(quantile_cont(y, 0.25), 6) AS q25,
        round(quantile_cont(y, 0.5), 6) AS q50, round(quantile_cont(y, 0.75), 6) AS q75, max(y) AS max
        FROM by_user GROUP BY 1"""
)
def describe_series(spark, sf_dir):
    return rounded(describe(by_user(spark, sf_dir)), "mean", "std", "q25", "q50", "q75")


@query(
    f"""WITH {_GRID} SELECT user_id, count(*) AS "rows", count(*) - count(y) AS missing_y,
        count(*) - count(y) AS missing_total FROM r GROUP BY 1"""
)
def missing_counts(spark, sf_dir):
    return missing(regular_grid(by_user(spark, sf_dir)))


@query(f'WITH {BY_USER} SELECT user_id, count(*) AS "rows", min(ts) AS start, max(ts) AS cutoff FROM by_user GROUP BY 1')
def series_extent(spark, sf_dir):
    return extent(by_user(spark, sf_dir))


@query(
    f"""WITH {BY_STATUS}, c AS (SELECT count(*) AS "rows" FROM by_status)
        SELECT CAST(position AS INTEGER) AS position, "column", "role", dtype, 'Hierarchical' AS scitype, "rows" FROM c,
        (VALUES (0, 'flag', 'key', 'string'), (1, 'status', 'key', 'string'),
                (2, 'ts', 'time', 'timestamp_ntz'), (3, 'y', 'target', 'double'),
                (4, 'X:x', 'exog', 'double')) t(position, "column", "role", dtype)"""
)
def frame_structure(spark, sf_dir):
    return structure(by_status(spark, sf_dir))


@query(
    """SELECT l_returnflag, l_linestatus,
              CAST(coalesce(min(l_linenumber) = max(l_linenumber), false) AS INTEGER) AS constant_l_linenumber,
              CAST(coalesce(min(l_linestatus) = max(l_linestatus), false) AS INTEGER) AS constant_status
       FROM lineitem GROUP BY 1, 2"""
)
def constant_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("status", F.col("l_linestatus"))
    tsf = with_roles(lines, ["l_returnflag", "l_linestatus"], "l_shipdate", "l_linenumber", ["status"])
    out = constants(tsf)
    return out.withColumns({c: flag(c) for c in ("constant_l_linenumber", "constant_status")})


@query(
    f"""WITH {BY_USER}, g AS (SELECT user_id, epoch_us(ts) - epoch_us(lag(ts) OVER (
          PARTITION BY user_id ORDER BY ts)) AS gap FROM by_user),
        s AS (SELECT user_id, count(*) >= 3 AND min(gap) = max(gap) AS exact, min(gap) AS gap FROM g GROUP BY 1)
        SELECT user_id, CASE WHEN exact AND gap <> 86400000000
          THEN concat(gap // 86400000000, 'D') ELSE 'D' END AS freq FROM s"""
)
def frequency_with_fallback(spark, sf_dir):
    return frequency_label(by_user(spark, sf_dir))


@query(
    """WITH h AS (SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, event_id,
            CASE WHEN value >= 20 THEN value END AS value, event_type FROM events),
       d AS (SELECT user_id, count(*) AS n, count(DISTINCT ts) AS times,
                    count(*) - count(value) AS miss, min(value) = max(value) AS const,
                    min(event_type) = max(event_type) AS const_type
             FROM h GROUP BY 1),
       back AS (SELECT user_id, ts < lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM h),
       bs AS (SELECT user_id, count(*) FILTER (WHERE b) AS backs FROM back GROUP BY 1),
       g AS (SELECT user_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap FROM h),
       f AS (SELECT user_id, min(gap) = max(gap) AND min(gap) > 0 AS regular FROM g GROUP BY 1)
       SELECT user_id, 'missing_pct:value' AS "check", 'warning' AS severity, round(miss / n * 100, 2) AS value FROM d WHERE miss > 0
       UNION ALL SELECT user_id, 'constant:value', 'warning', 1.0 FROM d WHERE const
       UNION ALL SELECT user_id, 'constant:event_type', 'warning', 1.0 FROM d WHERE const_type
       UNION ALL SELECT user_id, 'duplicate_times', 'warning', CAST(n - times AS DOUBLE) FROM d WHERE n > times
       UNION ALL SELECT user_id, 'short', 'warning', CAST(n AS DOUBLE) FROM d WHERE n < 10
       UNION ALL SELECT user_id, 'unsorted', 'warning', CAST(backs AS DOUBLE) FROM bs WHERE backs > 0
       UNION ALL SELECT user_id, 'no_frequency', 'warning', 1.0 FROM d JOIN f USING (user_id) WHERE n >= 3 AND NOT regular"""
)
def validation_report(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_id",
        F.when(F.col("value") >= 20, F.col("value")).alias("value"), "event_type",
    )
    tsf = with_roles(events, ["user_id"], "ts", "value", ["event_type"], ties=["event_id"])
    return validate(tsf, ingest="event_id")


@query("SELECT CAST(count(*) > 0 AS INTEGER) AS valid FROM orders")
def validation_verdict(spark, sf_dir):
    return is_valid(validate(by_priority(spark, sf_dir))).select(flag("valid").alias("valid"))
