"""Saving a series: target and exogenous columns stay on the same row."""

from __future__ import annotations

from collections.abc import Iterable

from chronoloom.frame import TimeSeriesFrame


def save(
    tsf: TimeSeriesFrame,
    path: str,
    format: str = "csv",
    overwrite: bool = False,
    partition_by: Iterable[str] = (),
    time_name: str | None = None,
) -> None:
    """Write csv, parquet or json. An existing path is refused unless `overwrite`.

    JSON is one record per line. The time is written under its own column name, or under
    `time_name`, which no other column may have.
    """
    if format not in ("csv", "parquet", "json"):
        raise ValueError(f"Unsupported format {format!r}; use csv, parquet or json")
    df = tsf.df.select(*tsf.columns())
    if time_name not in (None, tsf.time):
        if time_name in df.columns:
            raise ValueError(f"There is a column '{time_name}' already")
        df = df.withColumnRenamed(tsf.time, time_name)
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "csv":
        writer.option("header", True).csv(path)
    elif format == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.parquet(path)
