"""Registration of a query together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"Query {fn.__name__} exists twice")
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Doubles rounded, since engines add in different orders."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def flag(c: Column | str) -> Column:
    return F.col(c).cast("int") if isinstance(c, str) else c.cast("int")
