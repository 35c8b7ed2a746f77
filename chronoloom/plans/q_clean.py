"""Time-index cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.frame import with_roles
from chronoloom.operators.clean import (
    dedupe, duplicate_counts, fill_missing, format_series, infer_frequency, modal_frequency,
    off_grid_rows, regular_grid, sortedness, to_period,
)
from chronoloom.plans.panels import BY_PRIORITY, BY_USER, by_priority, by_user
from chronoloom.plans.registry import flag, query
from chronoloom.sources.datasets import table
from chronoloom.sources.readers import load


def _hourly(spark, sf_dir, unit="hour"):
    """Events with times cut to the hour or day, so that many times repeat."""
    events = table(spark, sf_dir, "events").select(
        "user_id", F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("ts"), "value", "event_id"
    )
    return with_roles(events, ["user_id"], "ts", "value", ["event_id"], ties=["event_id"])


_HOURLY = """h AS (SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, value, event_id FROM events)"""


@query(
    f"""WITH {_HOURLY} SELECT user_id, ts, value, event_id FROM h
        QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1"""
)
def dedupe_first(spark, sf_dir):
    return dedupe(_hourly(spark, sf_dir)).df


@query(
    f"""WITH {_HOURLY} SELECT user_id, count(*) AS "rows", count(DISTINCT ts) AS times,
        count(*) - count(DISTINCT ts) AS duplicates FROM h GROUP BY 1"""
)
def duplicate_report(spark, sf_dir):
    return duplicate_counts(_hourly(spark, sf_dir))


@query(
    """WITH s AS (SELECT o_orderpriority, o_orderdate < lag(o_orderdate) OVER (
          PARTITION BY o_orderpriority ORDER BY o_orderkey) AS back FROM orders)
       SELECT o_orderpriority, CAST(max(coalesce(back, false)) AS INTEGER) AS was_unsorted,
              count(*) FILTER (WHERE back) AS steps_back FROM s GROUP BY 1"""
)
def sort_report(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    tsf = with_roles(orders, ["o_orderpriority"], "o_orderdate", "o_totalprice", ["o_orderkey"])
    return sortedness(tsf, "o_orderkey").withColumn("was_unsorted", flag("was_unsorted"))


@query(
    f"""WITH {BY_USER}, g AS (SELECT user_id, epoch_us(ts) - epoch_us(lag(ts) OVER (
          PARTITION BY user_id ORDER BY ts)) AS gap FROM by_user),
        s AS (SELECT user_id, count(*) AS n, min(gap) AS lo, max(gap) AS hi FROM g GROUP BY 1)
        SELECT user_id, n AS "rows",
               CASE WHEN n >= 3 AND lo = hi THEN
                 CASE WHEN lo % 604800000000 = 0 THEN 'W' WHEN lo = 86400000000 THEN 'D'
                      ELSE concat(lo // 86400000000, 'D') END END AS freq
        FROM s"""
)
def infer_daily(spark, sf_dir):
    return infer_frequency(by_user(spark, sf_dir)).drop("step")


@query(
    f"""WITH {BY_PRIORITY}, g AS (SELECT priority, ts, datediff('month', lag(ts) OVER (
          PARTITION BY priority ORDER BY ts), ts) AS gap FROM by_priority)
        SELECT priority, count(*) AS "rows",
               CASE WHEN count(*) >= 3 AND min(gap) = max(gap) THEN 'MS' END AS freq
        FROM g GROUP BY 1"""
)
def infer_monthly(spark, sf_dir):
    return infer_frequency(by_priority(spark, sf_dir)).drop("step")


@query(
    """WITH h AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS ts FROM events),
       g AS (SELECT user_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap FROM h),
       c AS (SELECT user_id, gap, count(*) AS gap_rows FROM g WHERE gap IS NOT NULL GROUP BY 1, 2)
       SELECT user_id, gap, gap_rows,
              CASE WHEN gap // 86400000000 BETWEEN 28 AND 31 THEN 'MS'
                   WHEN gap % 604800000000 = 0 THEN
                     concat(CASE WHEN gap = 604800000000 THEN '' ELSE CAST(gap // 604800000000 AS VARCHAR) END, 'W')
                   WHEN gap % 86400000000 = 0 THEN
                     concat(CASE WHEN gap = 86400000000 THEN '' ELSE CAST(gap // 86400000000 AS VARCHAR) END, 'D')
                   ELSE concat(CASE WHEN gap = 3600000000 THEN '' ELSE CAST(gap // 3600000000 AS VARCHAR) END, 'h')
              END AS freq
       FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY gap_rows DESC, gap) = 1"""
)
def modal_hourly(spark, sf_dir):
    return modal_frequency(dedupe(_hourly(spark, sf_dir))).drop("step")


_GRID = f"""{BY_USER}, b AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM by_user GROUP BY 1),
  g AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM b),
  r AS (SELECT g.user_id, g.ts, u.y FROM g LEFT JOIN by_user u USING (user_id, ts))"""
_FILL = """coalesce(
    last_value({0} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING),
    first_value({0} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts
                                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(f"WITH {_GRID} SELECT user_id, ts, y FROM r")
def daily_grid(spark, sf_dir):
    return regular_grid(by_user(spark, sf_dir)).df


@query(f"WITH {_GRID} SELECT user_id, ts, {_FILL.format('y')} AS y FROM r")
def fill_both(spark, sf_dir):
    return fill_missing(regular_grid(by_user(spark, sf_dir))).df


@query(
    f"""WITH {_GRID}, f AS (SELECT user_id, ts, CASE WHEN y % 7 <> 0 THEN y END AS y FROM r)
        SELECT user_id, ts, last_value(y IGNORE NULLS) OVER (
          PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS y FROM f"""
)
def fill_forward(spark, sf_dir):
    tsf = regular_grid(by_user(spark, sf_dir))
    holes = tsf.with_df(tsf.df.withColumn("y", F.when(F.col("y") % 7 != 0, F.col("y"))))
    return fill_missing(holes, "ffill").df


@query(
    """WITH b AS (SELECT user_id, ts, min(ts) OVER (PARTITION BY user_id) AS lo FROM events)
       SELECT user_id, count(*) FILTER (WHERE (epoch_us(ts) - epoch_us(lo)) % 86400000000 <> 0)
              AS off_grid_rows FROM b GROUP BY 1"""
)
def off_grid(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return off_grid_rows(with_roles(events, ["user_id"], "ts", "value", []), "D")


@query(
    """SELECT event_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start,
              CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start,
              time_bucket(INTERVAL 15 MINUTE, ts) AS quarter_hour FROM events"""
)
def period_starts(spark, sf_dir):
    tsf = with_roles(table(spark, sf_dir, "events"), ["event_id"], "ts", "value", [])
    df = tsf.df.withColumn("month_start", F.col("ts")).withColumn("week_start", F.col("ts"))
    df = df.withColumnRenamed("ts", "quarter_hour")
    out = to_period(tsf.with_df(df, time="month_start"), "MS")
    out = to_period(out.with_df(out.df, time="week_start"), "W")
    out = to_period(out.with_df(out.df, time="quarter_hour"), "15min")
    return out.df.select("event_id", "month_start", "week_start", "quarter_hour")


_DAILY = """d AS (
    SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, value, event_id FROM events),
  u AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1),
  b AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM u GROUP BY 1),
  g AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM b),
  r AS (SELECT user_id, ts, value, event_id FROM g LEFT JOIN u USING (user_id, ts))"""


@query(
    f"""WITH {_DAILY} SELECT user_id, ts, {_FILL.format('value')} AS value,
        {_FILL.format('event_id')} AS event_id FROM r"""
)
def format_all(spark, sf_dir):
    return format_series(_hourly(spark, sf_dir, "day"))[0].df.select("user_id", "ts", "value", "event_id")


@query(
    f"""WITH {_DAILY} SELECT user_id, ts, {_FILL.format('value')} AS value,
        {_FILL.format('event_id')} AS event_id FROM r"""
)
def load_formatted(spark, sf_dir):
    # As format_all, from the source to the regular grid in one call.
    events = table(spark, sf_dir, "events")
    events.withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz")).createOrReplaceTempView("src_days")
    config = {
        "type": "sql", "table": "src_days", "key_columns": ["user_id"], "time_column": "ts", "target_column": "value",
        "exog_columns": ["event_id"], "tie_columns": ["event_id"], "frequency": "D",
    }
    return load(spark, config).df.select("user_id", "ts", "value", "event_id")


@query(
    f"""WITH {_DAILY}, i AS (SELECT user_id, count(*) AS rows_in FROM d GROUP BY 1),
        o AS (SELECT user_id, count(*) AS rows_out, count(*) - count(value) AS gaps FROM r GROUP BY 1),
        k AS (SELECT user_id, count(*) AS kept FROM u GROUP BY 1)
        SELECT user_id, rows_in, rows_in - kept AS duplicates_removed, 'D' AS frequency,
               CAST(0 AS BIGINT) AS off_grid_rows, CAST(0 AS BIGINT) AS null_time_rows, rows_out, gaps AS gaps_filled, gaps AS missing_filled
        FROM i JOIN o USING (user_id) JOIN k USING (user_id)"""
)
def format_report(spark, sf_dir):
    report = format_series(_hourly(spark, sf_dir, "day"))[1]
    return report.drop("frequency_set")
