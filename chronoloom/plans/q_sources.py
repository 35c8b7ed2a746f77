"""Sources, sinks, roles and layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.frame import parse_time, with_roles
from chronoloom.operators.clean import overlay, regular_grid, resample
from chronoloom.operators.inspect import head
from chronoloom.operators.reshape import (
    align, capped, from_nested, from_wide, hierarchy_totals, on_grid, to_nested, to_wide,
)
from chronoloom.plans.panels import (
    BY_PRIORITY, BY_STATUS, BY_TYPE, BY_USER, by_priority, by_status, by_type, by_user,
)
from chronoloom.plans.registry import query, rounded
from chronoloom.shared import shared_dir
from chronoloom.sources.datasets import dataset, table
from chronoloom.sources.filters import apply_filters
from chronoloom.sources.readers import load
from chronoloom.sources.writers import save


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def scan_parquet(spark, sf_dir):
    return load(
        spark,
        {
            "type": "file", "path": f"{sf_dir}/events.parquet", "key_columns": ["user_id"],
            "time_column": "ts", "target_column": "value", "exog_columns": ["event_id", "event_type"],
        },
        auto_format=False,
    ).df


@query(
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
       WHERE o_totalprice >= 200000 AND o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01'
         AND o_orderpriority <> '5-LOW'"""
)
def scan_filtered(spark, sf_dir):
    rules = {
        "o_totalprice": ">= 200000", "o_orderstatus": "F", "o_orderdate": ">=1997-01-01",
        "o_orderpriority": "!= 5-LOW",
    }
    return apply_filters(table(spark, sf_dir, "orders"), rules).select(
        "o_orderkey", "o_orderdate", "o_totalprice"
    )


def _reload(spark, sf_dir, fmt):
    source = with_roles(
        table(spark, sf_dir, "orders"), ["o_orderkey"], "o_orderdate", "o_totalprice", ["o_orderpriority"]
    )
    path = shared_dir(spark, f"save-{fmt}")
    save(source, path, fmt)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.df.schema)
    config = {
        "type": "file", "path": path, "format": fmt,
        "key_columns": ["o_orderkey"], "time_column": "o_orderdate", "target_column": "o_totalprice",
    }
    if fmt != "parquet":
        config["schema"] = schema
    return load(spark, config, auto_format=False).df


_ORDERS = "SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority FROM orders"


@query(_ORDERS)
def save_reload_csv(spark, sf_dir):
    return _reload(spark, sf_dir, "csv")


@query(_ORDERS)
def save_reload_json(spark, sf_dir):
    return _reload(spark, sf_dir, "json")


@query("SELECT o_orderkey, o_orderdate AS time, o_totalprice, o_orderpriority FROM orders")
def save_reload_json_time(spark, sf_dir):
    # Read back by the extension alone, with the types that the records show.
    source = with_roles(
        table(spark, sf_dir, "orders"), ["o_orderkey"], "o_orderdate", "o_totalprice", ["o_orderpriority"]
    )
    path = shared_dir(spark, "save") + ".json"
    save(source, path, "json", time_name="time")
    config = {
        "type": "file", "path": path, "key_columns": ["o_orderkey"], "time_column": "time",
        "target_column": "o_totalprice", "exog_columns": ["o_orderpriority"],
    }
    return load(spark, config, auto_format=False).df


@query("SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem")
def load_tsv(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp_ntz"), F.col("l_quantity").cast("double")
    )
    path = shared_dir(spark, "lines") + ".tsv"
    lines.write.option("sep", "\t").option("header", True).csv(path)
    config = {
        "type": "file", "path": path, "key_columns": ["l_orderkey", "l_linenumber"],
        "time_column": "l_shipdate", "target_column": "l_quantity",
        "schema": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema),
    }
    return load(spark, config, auto_format=False).df


@query("SELECT user_id, ts, value FROM events WHERE value >= 20")
def load_url(spark, sf_dir):
    config = {
        "type": "url", "url": f"{sf_dir}/events.parquet", "filters": {"value": ">= 20"}, "key_columns": ["user_id"],
        "time_column": "ts", "target_column": "value", "exog_columns": [],
    }
    return load(spark, config, auto_format=False).df


@query(_ORDERS)
def save_reload_parquet(spark, sf_dir):
    return _reload(spark, sf_dir, "parquet")


@query(
    """SELECT c_nationkey, o_orderdate, round(sum(o_totalprice), 2) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_totalprice > 100000 AND o_orderstatus = 'F' GROUP BY 1, 2"""
)
def sql_source(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("src_orders")
    table(spark, sf_dir, "customer").createOrReplaceTempView("src_customer")
    tsf = load(
        spark,
        {
            "type": "sql",
            "query": """SELECT c_nationkey, o_orderdate, round(sum(o_totalprice), 2) AS total
                        FROM src_orders JOIN src_customer ON o_custkey = c_custkey
                        WHERE o_totalprice > :least AND o_orderstatus = :status
                        GROUP BY c_nationkey, o_orderdate""",
            "query_params": {"least": 100000, "status": "F"},
            "key_columns": ["c_nationkey"], "time_column": "o_orderdate", "target_column": "total",
        },
        auto_format=False,
    )
    return tsf.df


@query(
    """SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, round(sum(value), 6) AS value
       FROM events GROUP BY 1, 2"""
)
def named_dataset(spark, sf_dir):
    return rounded(dataset(spark, sf_dir, "events_daily_by_type").df, "value")


@query(
    """SELECT l_returnflag, l_shipdate, l_extendedprice, l_quantity, l_tax FROM lineitem"""
)
def roles(spark, sf_dir):
    # The unknown column is dropped without an error.
    return with_roles(
        table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_shipdate", "l_extendedprice",
        ["l_quantity", "l_tax", "no_such_column"],
    ).df


@query("SELECT user_id, ts, CAST(event_id AS DOUBLE) AS event_id, event_type, value, props FROM events")
def roles_detected(spark, sf_dir):
    # Time column and target are found from the schema.
    return with_roles(table(spark, sf_dir, "events"), ["user_id"]).df


@query("SELECT o_orderkey, o_orderdate FROM orders")
def parse_text_time(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    return parse_time(table(spark, sf_dir, "orders").select("o_orderkey", text), "o_orderdate")


@query(
    f"""WITH {BY_USER} SELECT user_id, ts, y FROM by_user
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts) <= 5"""
)
def head_per_series(spark, sf_dir):
    return head(by_user(spark, sf_dir), 5)


@query("SELECT least(count(*), 500) AS shown, count(*) AS total FROM events")
def row_cap(spark, sf_dir):
    return capped(table(spark, sf_dir, "events"), 500)[1]


@query(f"WITH {BY_TYPE} SELECT event_type, ts, y FROM by_type")
def long_nested_long(spark, sf_dir):
    return from_nested(to_nested(by_type(spark, sf_dir)), ["event_type"])


@query(
    f"""WITH {BY_STATUS} SELECT flag, ts, sum(CASE WHEN status = 'F' THEN y END) AS "F",
        sum(CASE WHEN status = 'O' THEN y END) AS "O" FROM by_status GROUP BY 1, 2"""
)
def long_to_wide(spark, sf_dir):
    return to_wide(by_status(spark, sf_dir), "status", ["F", "O"])


@query(f"WITH {BY_STATUS} SELECT flag, ts, status, y FROM by_status WHERE status IN ('F', 'O')")
def wide_to_long(spark, sf_dir):
    wide = to_wide(by_status(spark, sf_dir), "status", ["F", "O"])
    return from_wide(wide, ["flag", "ts"], "status", ["F", "O"])


@query(
    f"""WITH {BY_PRIORITY}, b AS (
          SELECT o_orderpriority AS priority, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS ts,
                 CAST(count(*) AS DOUBLE) AS x
          FROM orders WHERE o_totalprice > 480000 GROUP BY 1, 2)
        SELECT priority, ts, y, x FROM by_priority FULL JOIN b USING (priority, ts)"""
)
def align_full_join(spark, sf_dir):
    large = table(spark, sf_dir, "orders").where("o_totalprice > 480000").select(
        F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("y"),
    )
    counts = resample(with_roles(large, ["priority"], "ts", "y"), "MS", "count")
    return align(by_priority(spark, sf_dir), counts)


@query(
    f"""WITH {BY_TYPE}, {BY_PRIORITY}
        SELECT 'Events' AS label, event_type, NULL AS priority, ts, y FROM by_type
        UNION ALL SELECT 'Series 2', NULL, priority, ts, y FROM by_priority"""
)
def overlay_series(spark, sf_dir):
    return overlay([by_type(spark, sf_dir), by_priority(spark, sf_dir)], ["Events"])


@query(
    f"""WITH {BY_STATUS}
        SELECT flag, status, ts, sum(y) AS total,
               CAST(2 - grouping(flag) - grouping(status) AS INTEGER) AS level
        FROM by_status GROUP BY GROUPING SETS ((flag, status, ts), (flag, ts), (ts))"""
)
def hierarchy(spark, sf_dir):
    return hierarchy_totals(by_status(spark, sf_dir))


@query(
    f"""WITH {BY_USER}, {BY_TYPE},
        g AS (SELECT user_id, min(ts) lo, max(ts) hi FROM by_user GROUP BY 1)
        SELECT g.user_id, d.ts, u.y FROM g
        JOIN (SELECT DISTINCT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS ts FROM g) d USING (user_id)
        LEFT JOIN by_user u ON u.user_id = g.user_id AND u.ts = d.ts"""
)
def reindex_on_grid(spark, sf_dir):
    tsf = by_user(spark, sf_dir)
    grid = regular_grid(tsf).df.select("user_id", "ts")
    return on_grid(grid, tsf)
