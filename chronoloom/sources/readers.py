"""Loading: inline rows, files at any Hadoop URI, catalog tables, JDBC."""

from __future__ import annotations

import re
from pathlib import PurePosixPath
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from chronoloom.frame import MAX_SERIES_ROWS, TimeSeriesFrame, with_roles
from chronoloom.operators.clean import format_series
from chronoloom.sources.filters import apply_filters

# File extension and the format that it means.
EXTENSIONS = {
    ".csv": "csv", ".txt": "csv", ".tsv": "tsv",
    ".parquet": "parquet", ".pq": "parquet", ".json": "json", ".jsonl": "jsonl",
}
FORMATS = ("csv", "tsv", "parquet", "json", "jsonl")
_NAME = re.compile(r"[a-zA-Z0-9_.]+")


def read_inline(spark: SparkSession, config: dict) -> DataFrame:
    """A dict of columns, a list of rows, or a pandas frame; small by nature."""
    data = config.get("data")
    if isinstance(data, dict):
        data = pd.DataFrame(data)
    if data is None:
        raise ValueError("Inline source needs 'data'")
    schema = config.get("schema")
    return spark.createDataFrame(data, schema) if schema else spark.createDataFrame(data)


def file_format(path: str, given: str | None = None) -> str:
    if given is not None:
        if given not in FORMATS:
            raise ValueError(f"Unsupported format {given!r}; use one of {list(FORMATS)}")
        return given
    suffix = PurePosixPath(urlsplit(path).path).suffix.lower()
    if suffix not in EXTENSIONS:
        raise ValueError(f"Cannot tell the format of {path!r}; give 'format' as one of {list(FORMATS)}")
    return EXTENSIONS[suffix]


def read_file(spark: SparkSession, config: dict) -> DataFrame:
    """One file, folder or glob, read in place (`file:`, `hdfs:`, `s3a:`, …)."""
    path = config.get("path") or config.get("url")
    if not path:
        raise ValueError("File source needs 'path' or 'url'")
    fmt = file_format(path, config.get("format"))
    reader = spark.read
    if config.get("schema") is not None:
        reader = reader.schema(config["schema"])
    options = dict(config.get("options", {}))
    if fmt in ("csv", "tsv"):
        options.setdefault("header", True)
        options.setdefault("sep", ",")
        if fmt == "tsv":
            options["sep"] = "\t"
        if config.get("schema") is None:
            options.setdefault("inferSchema", True)
        return reader.options(**options).csv(path)
    if fmt in ("json", "jsonl"):
        # An array of records spans lines; one record per line can be split by Spark.
        if fmt == "json" and "multiLine" not in options:
            options["multiLine"] = _spans_lines(spark, path)
        return reader.options(**options).json(path)
    return reader.options(**options).parquet(path)


def _spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether JSON starts with an array, or with a record that its first line does not close."""
    line = spark.read.text(path).filter("trim(value) <> ''").first()
    start = line.value.strip() if line else ""
    return start.startswith("[") or (start.startswith("{") and not start.endswith("}"))


def _checked(name: str, what: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"{what} name {name!r} may hold letters, digits, _ and . only")
    return name


def jdbc_options(config: dict) -> dict[str, str]:
    """Reader options; give partition_column, bounds and num_partitions for parallel reads."""
    if config.get("query_params"):
        raise ValueError("A JDBC query takes no parameters; use 'table' with 'filters', which are pushed down")
    options = {"url": config["url"], **config.get("options", {})}
    if config.get("query"):
        if config.get("table"):
            raise ValueError("Give 'query' or 'table', not both")
        options["query"] = config["query"]
    elif config.get("table"):
        options["dbtable"] = _checked(config["table"], "Table")
    else:
        raise ValueError("SQL source needs 'query' or 'table'")
    if config.get("partition_column"):
        if config.get("query"):
            raise ValueError("Parallel reads need 'table'")
        for key in ("lower_bound", "upper_bound", "num_partitions"):
            if config.get(key) is None:
                raise ValueError(f"partition_column needs {key}")
        options.update(
            partitionColumn=_checked(config["partition_column"], "Column"),
            lowerBound=str(config["lower_bound"]), upperBound=str(config["upper_bound"]),
            numPartitions=str(config["num_partitions"]),
        )
    options.setdefault("fetchsize", "10000")
    return options


def read_sql(spark: SparkSession, config: dict) -> DataFrame:
    """JDBC when there is a `url`; else a table or query of the Spark catalog."""
    for name in config.get("filters") or {}:
        _checked(name, "Column")
    if config.get("url"):
        return spark.read.format("jdbc").options(**jdbc_options(config)).load()
    if config.get("query"):
        return spark.sql(config["query"], args=config.get("query_params") or {})
    if config.get("table"):
        return spark.table(_checked(config["table"], "Table"))
    raise ValueError("SQL source needs 'query' or 'table'")


READERS = {"inline": read_inline, "file": read_file, "url": read_file, "sql": read_sql}


def load(spark: SparkSession, config: dict, auto_format: bool = True) -> TimeSeriesFrame:
    """Read a source, apply filters, give roles and, unless switched off, clean the times.

    Keys of `config`: type, the keys of that source, filters, key_columns, time_column,
    target_column, exog_columns, frequency, tie_columns, max_rows.
    """
    kind = config.get("type")
    if kind not in READERS:
        raise ValueError(f"Unknown source type {kind!r}; use one of {list(READERS)}")
    df = READERS[kind](spark, config)
    time_col = config.get("time_column")
    if time_col is None:
        from chronoloom.frame import detect_time_column

        time_col = detect_time_column(df.schema)
        if time_col is None and kind == "inline":
            # No time at all: rows count up in the order given.
            data = config["data"]
            frame = pd.DataFrame(data).reset_index(drop=True)
            frame.insert(0, "index", range(len(frame)))
            kinds = {f.name: f.dataType for f in df.schema}
            df = spark.createDataFrame(frame)
            df = df.select("index", *[df[c].cast(kinds[c]) for c in df.columns if c in kinds])
            time_col = "index"
    df = apply_filters(df, config.get("filters"))
    tsf = with_roles(
        df,
        config.get("key_columns", ()),
        time_col,
        config.get("target_column"),
        config.get("exog_columns"),
        config.get("frequency"),
        config.get("tie_columns", ()),
        config.get("max_rows", MAX_SERIES_ROWS),
    )
    return format_series(tsf)[0] if auto_format else tsf
