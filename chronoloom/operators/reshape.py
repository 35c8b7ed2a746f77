"""Long, wide and nested layouts; alignment; hierarchy totals; row caps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import null_safe_join


def to_nested(tsf: TimeSeriesFrame) -> DataFrame:
    """`(keys…, part, points ARRAY<STRUCT<ts, y>>)` in time order.

    A series of usual length is one row with part 0; a longer one is one row per time
    chunk, since an unbounded array would have to fit one task.
    """
    from chronoloom.functions.ordered import CHUNK, chunked

    points = F.array_sort(F.collect_list(F.struct(tsf.ts.alias("ts"), tsf.y.alias("y"))))
    return (
        chunked(tsf).groupBy(*tsf.keys, F.col(CHUNK).alias("part")).agg(points.alias("points"))
    )


def from_nested(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.explode("points").alias("p")).select(*keys, "p.ts", "p.y")


def to_wide(tsf: TimeSeriesFrame, key: str, values: list) -> DataFrame:
    """One column per listed value of `key`, one row per time and other keys."""
    rest = [k for k in tsf.keys if k != key]
    return (
        tsf.df.groupBy(*rest, F.col(tsf.time).alias("ts")).pivot(key, values).agg(F.first(tsf.y, True))
    )


def from_wide(df: DataFrame, ids: list[str], key: str, values: list[str]) -> DataFrame:
    out = df.unpivot(ids, values, key, "y")
    return out.where("y is not null")


def reshape(tsf: TimeSeriesFrame, to: str = "long", key: str | None = None, values=None) -> DataFrame:
    if to == "long":
        return tsf.df.select(*tsf.columns())
    if to == "nested":
        return to_nested(tsf)
    if to == "wide":
        if key is None or values is None:
            raise ValueError("wide needs the key column and its values")
        return to_wide(tsf, key, list(values))
    raise ValueError(f"Cannot convert to {to!r}; use long, wide or nested")


def align(left: TimeSeriesFrame, right: TimeSeriesFrame) -> DataFrame:
    """Full outer alignment of two frames on key and time."""
    if left.keys != right.keys:
        raise ValueError(f"Keys differ: {left.keys} and {right.keys}")
    a = left.df.select(*left.keys, left.ts.alias("ts"), left.y.alias("__y"), F.lit(True).alias("__a"))
    b = right.df.select(
        *[F.col(k).alias(f"__{k}") for k in right.keys], right.ts.alias("__ts"),
        right.y.alias("__x"), F.lit(True).alias("__b"),
    )
    same = a["ts"].eqNullSafe(b["__ts"])
    for k in left.keys:
        same = same & a[k].eqNullSafe(b[f"__{k}"])
    out = a.join(b, same, "full")
    have = F.col("__a").isNotNull()
    return out.select(
        *[F.when(have, F.col(k)).otherwise(F.col(f"__{k}")).alias(k) for k in left.keys],
        F.when(have, F.col("ts")).otherwise(F.col("__ts")).alias("ts"),
        F.col("__y").alias("y"), F.col("__x").alias("x"),
    )


def on_grid(grid: DataFrame, tsf: TimeSeriesFrame) -> DataFrame:
    """Re-index: rows of a grid `(keys…, ts)` with the observed target or NULL."""
    seen = tsf.df.select(*tsf.keys, tsf.ts.alias("ts"), tsf.y.alias("y"))
    return null_safe_join(grid, seen, [*tsf.keys, "ts"], "left")


def hierarchy_totals(tsf: TimeSeriesFrame) -> DataFrame:
    """Sums at every level of the key hierarchy; `level` counts the keys in use."""
    keys = list(tsf.keys)
    sets = [keys[:i] for i in range(len(keys), -1, -1)]
    flat = tsf.df.select(*keys, tsf.ts.alias("ts"), tsf.y.alias("y"))
    # One aggregate for the leaves; the upper levels are sums of those.
    leaves = flat.groupBy(*keys, "ts").agg(F.sum("y").alias("y"))
    out = leaves.groupingSets(
        [[*(F.col(k) for k in s), F.col("ts")] for s in sets], *[F.col(k) for k in keys], F.col("ts")
    ).agg(F.sum("y").alias("total"), F.grouping_id().alias("__g"))
    level = sum(
        (1 - F.getbit("__g", F.lit(len(keys) - i))).cast("int") for i in range(len(keys))
    )
    return out.select(*keys, "ts", level.alias("level"), "total")


def capped(df: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """For showing only: at most n rows, and one row `(shown, total)`."""
    if n < 1:
        raise ValueError("n must be positive")
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return df.limit(n), total.select(F.least("total", F.lit(n).cast("bigint")).alias("shown"), "total")
