"""Base panels of the registered queries, and the same panels in SQL.

Targets are whole numbers (cents, or thousands), so that sums do not depend on the
order in which an engine adds them up.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame, with_roles
from chronoloom.operators.clean import resample
from chronoloom.sources.datasets import table


def _panel(df, keys, time, value, freq, scale, exog=None) -> TimeSeriesFrame:
    raw = df.select(*keys, F.col(time).alias("ts"), F.col(value).alias("y"), *(exog or []))
    tsf = resample(with_roles(raw, keys, "ts", "y", exog or []), freq, "sum", {c: "sum" for c in exog or []})
    return tsf.with_df(tsf.df.withColumn("y", F.round(F.col("y") * scale)))


def by_user(spark: SparkSession, sf_dir: str) -> TimeSeriesFrame:
    """Daily cents per user; most users miss some days."""
    return _panel(table(spark, sf_dir, "events"), ["user_id"], "ts", "value", "D", 100)


def by_type(spark: SparkSession, sf_dir: str) -> TimeSeriesFrame:
    """Daily cents per event type."""
    return _panel(table(spark, sf_dir, "events"), ["event_type"], "ts", "value", "D", 100)


def by_priority(spark: SparkSession, sf_dir: str) -> TimeSeriesFrame:
    """Monthly order value in thousands per priority."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "priority")
    return _panel(orders, ["priority"], "o_orderdate", "o_totalprice", "MS", 0.001)


def by_status(spark: SparkSession, sf_dir: str) -> TimeSeriesFrame:
    """Monthly line value in thousands per return flag and status, with quantity."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        "l_shipdate", "l_extendedprice", F.col("l_quantity").alias("x"),
    )
    return _panel(lines, ["flag", "status"], "l_shipdate", "l_extendedprice", "MS", 0.001, ["x"])


BY_USER = """by_user AS (
  SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, round(sum(value) * 100) AS y
  FROM events GROUP BY 1, 2)"""
BY_TYPE = """by_type AS (
  SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, round(sum(value) * 100) AS y
  FROM events GROUP BY 1, 2)"""
BY_PRIORITY = """by_priority AS (
  SELECT o_orderpriority AS priority, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS ts,
         round(sum(o_totalprice) * 0.001) AS y
  FROM orders GROUP BY 1, 2)"""
BY_STATUS = """by_status AS (
  SELECT l_returnflag AS flag, l_linestatus AS status,
         CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS ts,
         round(sum(l_extendedprice) * 0.001) AS y, sum(l_quantity) AS x
  FROM lineitem GROUP BY 1, 2, 3)"""


def placed(name: str, keys: str) -> str:
    """CTE `p` with position and length."""
    return f"""p AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts) - 1 AS pos,
         count(*) OVER (PARTITION BY {keys}) AS n
  FROM {name})"""


PRIORITY_POS = f"{BY_PRIORITY}, {placed('by_priority', 'priority')}"
TYPE_POS = f"{BY_TYPE}, {placed('by_type', 'event_type')}"
USER_POS = f"{BY_USER}, {placed('by_user', 'user_id')}"
STATUS_POS = f"{BY_STATUS}, {placed('by_status', 'flag, status')}"
