"""Point anomalies and change points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import attach, nearby, positions, running
from chronoloom.shared import cut_lineage

# Ratio of standard deviation to median absolute deviation under the normal.
MAD_TO_SIGMA = 1.4826


def _median(sorted_array: Column) -> Column:
    n = F.size(sorted_array)
    low = F.get(sorted_array, F.call_function("div", n - 1, F.lit(2)).cast("int"))
    high = F.get(sorted_array, F.call_function("div", n, F.lit(2)).cast("int"))
    return (low + high) / 2


def hampel(tsf: TimeSeriesFrame, window: int = 5, k: float = 3.0) -> DataFrame:
    """`(keys…, ts, y, median, mad, anomaly)`.

    A value is an anomaly when it lies more than k robust standard deviations from the
    median of the rows at most `window` away. Windows are cut at the ends.
    """
    if window < 1 or k <= 0:
        raise ValueError("window and k must be positive")
    around = nearby(
        tsf, window, window,
        lambda w: {"__ys": F.collect_list(tsf.target).over(w.rowsBetween(-window, window))},
    ).df
    df = around.withColumn("__ys", F.array_sort("__ys")).withColumn("median", _median(F.col("__ys")))
    off = F.array_sort(F.transform("__ys", lambda v: F.abs(v - F.col("median"))))
    df = df.withColumn("__off", off).withColumn("mad", _median(F.col("__off")))
    anomaly = F.abs(tsf.y - F.col("median")) > k * MAD_TO_SIGMA * F.col("mad")
    return df.select(
        *tsf.keys, tsf.ts.alias("ts"), tsf.y.alias("y"), "median", "mad",
        F.coalesce(anomaly, F.lit(False)).alias("anomaly"),
    )


def change_points(
    tsf: TimeSeriesFrame, n_points: int = 1, min_size: int = 1, min_gain: float = 0.0
) -> DataFrame:
    """`(keys…, round, pos, ts, gain)`: binary segmentation for shifts of the mean.

    Each round splits, per series, the segment whose best split takes most off the sum
    of squares; `pos` and `ts` are the last row before the change. Prefix sums are made
    once; a round is one aggregate that keeps the best row of each series. With more rounds,
    the sums and what each round found are checkpointed, so that work grows with the rounds.
    """
    if n_points < 1 or min_size < 1:
        raise ValueError("n_points and min_size must be positive")
    keys = list(tsf.keys)
    known = tsf.with_df(tsf.df.where(tsf.y.isNotNull()))
    rows = running(positions(known, "__pos", "__n"), {"__s": ("sum", tsf.y)})
    rows = rows.with_df(rows.df.select(*keys, tsf.time, "__pos", "__n", "__s"))
    if n_points > 1:
        rows = rows.with_df(cut_lineage(rows.df))
    segment = F.struct(
        F.lit(0).cast("bigint").alias("a"), (F.max("__n") - 1).alias("b"),
        F.lit(0.0).alias("sa"), F.max_by("__s", "__pos").alias("sb"),
    )
    state = rows.df.groupBy(*keys).agg(F.array(segment).alias("segs"))
    found = None
    for number in range(1, n_points + 1):
        here = F.filter("segs", lambda s: F.col("__pos").between(s["a"], s["b"]))
        df = attach(rows, state).df.withColumn("seg", F.get(here, F.lit(0)))
        left, right = F.col("__pos") - F.col("seg.a") + 1, F.col("seg.b") - F.col("__pos")
        shift = (F.col("__s") - F.col("seg.sa")) / left - (F.col("seg.sb") - F.col("__s")) / right
        df = df.where((left >= min_size) & (right >= min_size))
        gain = left * right / (left + right) * shift * shift
        best = df.withColumn("gain", gain).groupBy(*keys).agg(
            F.max_by(
                F.struct("seg", "segs", F.col("__pos").alias("pos"), F.col(tsf.time).alias("ts"), F.col("__s").alias("s"), "gain"),
                F.struct(F.round("gain", 9), -F.col("__pos")),
            ).alias("b")
        )
        best = best.where(F.col("b.gain") > min_gain)
        if n_points > 1:
            best = cut_lineage(best)
        part = best.select(*keys, F.lit(number).alias("round"), "b.pos", "b.ts", "b.gain")
        found = part if found is None else found.unionByName(part)
        cut = F.col("b.seg")
        halves = F.array(
            F.struct(cut["a"].alias("a"), F.col("b.pos").alias("b"), cut["sa"].alias("sa"), F.col("b.s").alias("sb")),
            F.struct((F.col("b.pos") + 1).alias("a"), cut["b"].alias("b"), F.col("b.s").alias("sa"), cut["sb"].alias("sb")),
        )
        others = F.filter("b.segs", lambda s: s["a"] != F.col("b.seg.a"))
        state = best.select(*keys, F.concat(others, halves).alias("segs"))
    return found
