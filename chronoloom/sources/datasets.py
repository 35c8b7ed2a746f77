"""Named panels over the tables of a folder, all as (frame with roles)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronoloom.frame import TimeSeriesFrame, with_roles
from chronoloom.operators.clean import resample
from chronoloom.operators.panel import instances


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events_by(key: str) -> Callable[[SparkSession, str], TimeSeriesFrame]:
    def make(spark, sf_dir):
        raw = table(spark, sf_dir, "events").select(key, "ts", "value")
        return resample(with_roles(raw, [key], "ts", "value"), "D", "sum")

    return make


def _orders_monthly(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate", "o_totalprice")
    return resample(with_roles(raw, ["o_orderpriority"], "o_orderdate", "o_totalprice"), "MS", "sum")


def _lineitem_monthly(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice", "l_quantity"
    )
    roles = with_roles(raw, ["l_returnflag", "l_linestatus"], "l_shipdate", "l_extendedprice")
    return resample(roles, "MS", "sum", exog={"l_quantity": "sum"})


def _embeddings(spark, sf_dir):
    return instances(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


DATASETS: dict[str, tuple[str, Callable]] = {
    "events_daily_by_user": ("forecasting", _events_by("user_id")),
    "events_daily_by_type": ("forecasting", _events_by("event_type")),
    "orders_monthly": ("forecasting", _orders_monthly),
    "lineitem_monthly": ("forecasting", _lineitem_monthly),
    "embeddings": ("classification", _embeddings),
}


def dataset(spark: SparkSession, sf_dir: str, name: str):
    """A TimeSeriesFrame, or instances `(id, values, label)` for classification."""
    if name not in DATASETS:
        raise ValueError(f"Unknown dataset {name!r}; use one of {list(DATASETS)}")
    return DATASETS[name][1](spark, sf_dir)


def list_datasets(task: str | None = None) -> dict[str, list[str]]:
    """Dataset names grouped by task."""
    out: dict[str, list[str]] = {}
    for name, (kind, _) in DATASETS.items():
        if task in (None, kind):
            out.setdefault(kind, []).append(name)
    return out
