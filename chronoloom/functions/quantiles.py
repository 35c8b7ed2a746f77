"""Exact quantiles per series, also for series too long for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import attach, null_safe_join
from chronoloom.shared import cut_lineage

_BINS = 1024
# Long series up to this many are listed on every executor.
_FEW = 10_000


def exact_quantiles(tsf: TimeSeriesFrame, probs: list[float]) -> DataFrame:
    """`(keys…, q ARRAY<DOUBLE>)` with linear interpolation between ranks."""
    if not tsf.width:
        return tsf.df.groupBy(*tsf.keys).agg(percentiles(tsf, probs).alias("q"))
    return _by_histogram(tsf, probs)


def percentiles(tsf: TimeSeriesFrame, probs: list[float]) -> Column:
    """The same as an aggregate; its state holds a whole series, so for short ones only."""
    return F.percentile(tsf.y, [float(p) for p in probs])


def with_quantiles(
    tsf: TimeSeriesFrame, rows: DataFrame, aggs: dict[str, Column], probs: list[float]
) -> DataFrame:
    """Aggregates of `rows` per series together with exact quantiles of the target as `q`."""
    named = [a.alias(n) for n, a in aggs.items()]
    if not tsf.width:
        return rows.groupBy(*tsf.keys).agg(*named, percentiles(tsf, probs).alias("q"))
    return null_safe_join(
        rows.groupBy(*tsf.keys).agg(*named), _by_histogram(tsf, probs), tsf.keys, "left"
    )


def _by_histogram(tsf: TimeSeriesFrame, probs: list[float]) -> DataFrame:
    """Short series by the built-in aggregate; each rank of a long one by counting bins.

    A long series has over `max_rows` rows, so there are at most rows / max_rows of them
    and their list is broadcast while it is short. Per pass, the value range that holds
    a wanted rank is cut into 1024 bins, which are counted with partial aggregation. A
    range is final when it holds one value or at most `max_rows` rows.
    """
    keys = list(tsf.keys)
    sizes = tsf.df.where(tsf.y.isNotNull()).groupBy(*keys).agg(
        F.count(tsf.y).alias("n"), F.min(tsf.y).alias("lo"), F.max(tsf.y).alias("hi")
    )
    long = cut_lineage(sizes.where(F.col("n") > tsf.max_rows))
    few = long.limit(_FEW + 1).count() <= _FEW
    mark = long.select(*keys, F.lit(True).alias("__long"))
    marked = null_safe_join(tsf.df, F.broadcast(mark), keys, "left") if few else attach(tsf, mark, "left").df
    short = tsf.with_df(marked.where("__long is null"))
    rows = tsf.with_df(marked.where(tsf.y.isNotNull() & F.col("__long")).withColumn("v", tsf.y))
    easy = short.df.groupBy(*keys).agg(percentiles(short, probs).alias("q"))
    return easy.unionByName(_long_quantiles(rows, long, probs, few))


def _long_quantiles(
    rows: TimeSeriesFrame, sizes: DataFrame, probs: list[float], few: bool
) -> DataFrame:
    keys = list(rows.keys)
    n_minus_1 = F.col("n") - 1
    wanted = [(i, F.lit(float(p)) * n_minus_1) for i, p in enumerate(probs)]
    ranks = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"), F.lit(side).alias("side"),
                (F.floor(at) if side == 0 else F.ceil(at)).cast("bigint").alias("rank"),
                (at - F.floor(at)).alias("part"),
            )
            for i, at in wanted
            for side in (0, 1)
        ]
    )
    ranges = (
        sizes.select(*keys, F.explode(ranks).alias("r"), "lo", "hi", F.col("n").alias("inside"))
        .select(*keys, "r.*", "lo", "hi", "inside")
    )
    ids = [*keys, "i", "side"]
    while True:
        ranges = cut_lineage(ranges)
        top = ranges.where("hi > lo").agg(F.max("inside")).first()[0] or 0
        if top <= rows.max_rows:
            break
        bins = _members(rows, ranges, few).groupBy(*ids, _bin().alias("bin")).agg(
            F.count("v").alias("c"), F.min("v").alias("b_lo"), F.max("v").alias("b_hi")
        )
        upto = F.sum("c").over(W.partitionBy(*ids).orderBy("bin"))
        counted = null_safe_join(bins.withColumn("upto", upto), ranges, ids)
        ranges = counted.where("rank < upto and rank >= upto - c").select(
            *ids, (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"), "part",
            F.col("b_lo").alias("lo"), F.col("b_hi").alias("hi"), F.col("c").alias("inside"),
        )
    single = ranges.where("hi = lo").select(*ids, "part", F.col("lo").alias("v"))
    order = W.partitionBy(*ids).orderBy("v")
    rest = _members(rows, ranges.where("hi > lo"), few).withColumn(
        "at", F.row_number().over(order) - 1
    )
    rest = rest.where("at = rank").select(*ids, "part", "v")
    per_prob = single.unionByName(rest).groupBy(*keys, "i").agg(
        F.max(F.when(F.col("side") == 0, F.col("v"))).alias("a"),
        F.max(F.when(F.col("side") == 1, F.col("v"))).alias("b"),
        F.max("part").alias("part"),
    )
    value = (F.lit(1.0) - F.col("part")) * F.col("a") + F.col("part") * F.col("b")
    return per_prob.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", value.alias("q")))), lambda s: s["q"]).alias("q")
    )


def _bin() -> Column:
    """Bin of `v` in its range; both ends have their own, so that every pass narrows it."""
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    share = F.nanvl((v - lo) / (hi - lo), F.lit(0.0))
    inner = 1 + F.least(F.floor(share * _BINS), F.lit(_BINS - 1))
    return F.when(v == lo, F.lit(0)).when(v == hi, F.lit(_BINS + 1)).otherwise(inner)


def _members(rows: TimeSeriesFrame, ranges: DataFrame, few: bool) -> DataFrame:
    """Rows with the ranges they fall in; one short array of ranges per series."""
    per_key = ranges.groupBy(*rows.keys).agg(
        F.collect_list(F.struct("i", "side", "rank", "part", "lo", "hi", "inside")).alias("rs")
    )
    joined = (
        null_safe_join(rows.df, F.broadcast(per_key), rows.keys) if few else attach(rows, per_key).df
    )
    inside = F.filter("rs", lambda r: F.col("v").between(r["lo"], r["hi"]))
    return joined.withColumn("r", F.explode(inside)).select(*rows.keys, "v", "r.*")

