"""Ordered computations over series of any length.

While every series is measured to fit one task, these are plain windows over the
series key. A frame with a longer series is cut into time chunks: each chunk is
summarised on its own, the short table of summaries (one row per chunk) is scanned
per key to get what has to be carried into each chunk, and the carried values are
joined back on (key, chunk). No task ever sees a whole long series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.steps import floor_div, ticks

CHUNK = "__chunk"
BLOCK = "__block"
# Default of spark.sql.optimizer.windowGroupLimitThreshold.
GROUP_LIMIT = 1000


def null_safe_join(left: DataFrame, right: DataFrame, on: Iterable[str], how="inner") -> DataFrame:
    """Join that keeps NULL keys together, so no series is lost."""
    on = list(on)
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    condition = None
    for c in on:
        equal = left[c].eqNullSafe(renamed[f"__r_{c}"])
        condition = equal if condition is None else condition & equal
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])


def order_of(tsf: TimeSeriesFrame) -> list[Column]:
    return [F.col(tsf.time), *[F.col(t) for t in tsf.ties if t in tsf.df.columns]]


def series_window(tsf: TimeSeriesFrame) -> WindowSpec:
    return W.partitionBy(*tsf.keys).orderBy(*order_of(tsf))


def chunked(tsf: TimeSeriesFrame) -> DataFrame:
    """The frame with its chunk number; a constant while series are short."""
    if not tsf.width:
        return tsf.df.withColumn(CHUNK, F.lit(0).cast("bigint"))
    position = ticks(F.col(tsf.time), tsf.time_type)
    return tsf.df.withColumn(CHUNK, floor_div(position, tsf.width))


def _chunk_window(tsf: TimeSeriesFrame) -> WindowSpec:
    return W.partitionBy(*tsf.keys, CHUNK).orderBy(*order_of(tsf))


def _carry(tsf: TimeSeriesFrame, df: DataFrame, partials, carried) -> DataFrame:
    """Join per-chunk summaries, scanned over the chunks of a key, back to the rows."""
    summary = df.groupBy(*tsf.keys, CHUNK).agg(*[c.alias(n) for n, c in partials.items()])
    over_chunks = W.partitionBy(*tsf.keys).orderBy(CHUNK)
    scan = summary.select(
        *tsf.keys, CHUNK, *[make(over_chunks).alias(n) for n, make in carried.items()]
    )
    return null_safe_join(df, scan, [*tsf.keys, CHUNK])


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(W.unboundedPreceding, -1)


def _everything(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def positions(tsf: TimeSeriesFrame, pos="pos", size: str | None = "n") -> TimeSeriesFrame:
    """0-based position in time order, and the series length, on every row."""
    if not tsf.width:
        df = tsf.df.withColumn(pos, (F.row_number().over(series_window(tsf)) - 1).cast("bigint"))
        if size:
            df = df.withColumn(size, F.count(F.lit(1)).over(W.partitionBy(*tsf.keys)))
        return tsf.with_df(df)
    df = _carry(
        tsf,
        chunked(tsf),
        {"__n": F.count(F.lit(1))},
        {
            "__offset": lambda w: F.coalesce(F.sum("__n").over(_before(w)), F.lit(0)),
            "__total": lambda w: F.sum("__n").over(_everything(w)),
        },
    )
    df = df.withColumn(pos, F.row_number().over(_chunk_window(tsf)) - 1 + F.col("__offset"))
    if size:
        df = df.withColumn(size, F.col("__total"))
    return tsf.with_df(df.drop(CHUNK, "__offset", "__total"))


_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_START = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def running(tsf: TimeSeriesFrame, aggs: dict[str, tuple[str, Column]]) -> TimeSeriesFrame:
    """Prefix aggregates from the first row of the series to the current one.

    `aggs` maps a new column to (kind, expression), kind in sum, count, min, max.
    """
    if not tsf.width:
        w = series_window(tsf).rowsBetween(W.unboundedPreceding, 0)
        return tsf.with_df(
            tsf.df.withColumns({n: _START[kind](e).over(w) for n, (kind, e) in aggs.items()})
        )
    partials = {f"__p_{n}": _START[kind](e) for n, (kind, e) in aggs.items()}
    carried = {
        f"__c_{n}": (lambda w, n=n, kind=kind: _COMBINE[kind](f"__p_{n}").over(_before(w)))
        for n, (kind, _) in aggs.items()
    }
    df = _carry(tsf, chunked(tsf), partials, carried)
    w = _chunk_window(tsf).rowsBetween(W.unboundedPreceding, 0)
    merged = {}
    for n, (kind, e) in aggs.items():
        here, earlier = _START[kind](e).over(w), F.col(f"__c_{n}")
        if kind in ("sum", "count"):
            merged[n] = F.coalesce(here + earlier, here, earlier)
        else:
            merged[n] = (F.least if kind == "min" else F.greatest)(here, earlier)
    return tsf.with_df(df.withColumns(merged).drop(CHUNK, *carried))


def filled(tsf: TimeSeriesFrame, cols: Iterable[str], forward=True, backward=True) -> TimeSeriesFrame:
    """Last known value first, then the next known one, for each listed column.

    No frame runs from the current row to the end, which Spark would evaluate from
    scratch for every row: after a forward fill only leading rows are left, and their
    next known value is the first one; a back fill alone runs over descending time.
    """
    cols = list(cols)
    order = [*tsf.keys, CHUNK] if tsf.width else list(tsf.keys)
    part = W.partitionBy(*order)
    up, down = part.orderBy(*order_of(tsf)), part.orderBy(*[c.desc() for c in order_of(tsf)])
    df, prev, nxt = tsf.df, {}, {}
    if tsf.width:
        partials, carried = {}, {}
        for i, c in enumerate(cols):
            known = F.when(F.col(c).isNotNull(), F.col(tsf.time))
            partials[f"__l{i}"] = F.max_by(F.col(c), known)
            partials[f"__f{i}"] = F.min_by(F.col(c), known)
            prev[c], nxt[c] = f"__prev{i}", f"__next{i}"
            carried[prev[c]] = lambda w, i=i: F.last(f"__l{i}", True).over(_before(w))
            carried[nxt[c]] = lambda _, i=i: F.last(f"__f{i}", True).over(
                _before(W.partitionBy(*tsf.keys).orderBy(F.desc(CHUNK)))
            )
        df = _carry(tsf, chunked(tsf), partials, carried)
    exprs = {}
    # New names, so that every fill reads the unfilled column.
    fresh = {c: f"__filled_{i}" for i, c in enumerate(cols)}
    for c in cols:
        options = [F.col(c)]
        if forward:
            options.append(F.last(c, True).over(up.rowsBetween(W.unboundedPreceding, 0)))
            options += [F.col(prev[c])] if prev else []
        if backward:
            if forward:
                options.append(F.first(c, True).over(_everything(up)))
            else:
                options.append(F.last(c, True).over(down.rowsBetween(W.unboundedPreceding, 0)))
            options += [F.col(nxt[c])] if nxt else []
        exprs[fresh[c]] = F.coalesce(*options)
    out = df.withColumns(exprs)
    return tsf.with_df(
        out.select(*[F.col(fresh[c]).alias(c) if c in fresh else F.col(c) for c in tsf.df.columns])
    )


def attach(tsf: TimeSeriesFrame, table: DataFrame, how="inner") -> TimeSeriesFrame:
    """Put a table with one row per series on every row of that series.

    Long series are joined on (key, chunk), so that no join partition holds a whole one.
    """
    if not tsf.width:
        return tsf.with_df(null_safe_join(tsf.df, table, tsf.keys, how))
    df = chunked(tsf)
    per_chunk = null_safe_join(df.select(*tsf.keys, CHUNK).distinct(), table, tsf.keys, how)
    return tsf.with_df(null_safe_join(df, per_chunk, [*tsf.keys, CHUNK], how).drop(CHUNK))


def whole(tsf: TimeSeriesFrame, aggs: dict[str, Column]) -> TimeSeriesFrame:
    """Aggregates over the whole series, on every row of it."""
    if not tsf.width:
        w = W.partitionBy(*tsf.keys)
        return tsf.with_df(tsf.df.withColumns({n: a.over(w) for n, a in aggs.items()}))
    return attach(tsf, tsf.df.groupBy(*tsf.keys).agg(*[a.alias(n) for n, a in aggs.items()]))


def nearby(
    tsf: TimeSeriesFrame,
    before: int,
    after: int,
    exprs: Callable[[WindowSpec], dict[str, Column]],
) -> TimeSeriesFrame:
    """Window expressions that reach at most `before` rows back and `after` rows ahead.

    For long series the rows are cut into blocks by position, and the rows at the
    borders are copied into the neighbouring block. Copies are dropped afterwards.
    """
    if not tsf.width:
        return tsf.with_df(tsf.df.withColumns(exprs(series_window(tsf))))
    block = max(tsf.max_rows, before, after, 1)
    df = positions(tsf, "__place", None).df
    own = floor_div(F.col("__place"), block)
    within = F.col("__place") - own * block
    homes = F.array_compact(
        F.array(
            F.lit(0),
            F.when(within >= block - before, F.lit(1)) if before else F.lit(None).cast("int"),
            F.when(within < after, F.lit(-1)) if after else F.lit(None).cast("int"),
        )
    )
    spread = df.withColumn("__home", F.explode(homes)).withColumn(BLOCK, own + F.col("__home"))
    w = W.partitionBy(*tsf.keys, BLOCK).orderBy("__place")
    out = spread.withColumns(exprs(w)).where("__home = 0")
    return tsf.with_df(out.drop("__place", "__home", BLOCK))


def lagged(tsf: TimeSeriesFrame, cols: dict[str, tuple[str | Column, int]]) -> TimeSeriesFrame:
    """Values k rows earlier (k < 0: later), as {new column: (expression, k)}."""
    back = max([k for _, k in cols.values() if k > 0], default=0)
    ahead = max([-k for _, k in cols.values() if k < 0], default=0)
    return nearby(
        tsf, back, ahead, lambda w: {n: F.lag(e, k).over(w) for n, (e, k) in cols.items()}
    )


def head_rows(tsf: TimeSeriesFrame, n: int, last=False, rank="rn") -> DataFrame:
    """First (or last) n rows of each series.

    Spark limits each key inside every input partition before the shuffle
    (WindowGroupLimit), so a long series costs no more than n rows per partition.
    Beyond the n Spark applies that to, positions are counted instead.
    """
    if n >= GROUP_LIMIT and tsf.width:
        df = positions(tsf, "__pos", "__size").df
        at = F.col("__size") - F.col("__pos") if last else F.col("__pos") + 1
        return df.withColumn(rank, at).where(F.col(rank) <= n).drop("__pos", "__size")
    order = [c.desc() for c in order_of(tsf)] if last else order_of(tsf)
    ranked = tsf.df.withColumn(rank, F.row_number().over(W.partitionBy(*tsf.keys).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)
