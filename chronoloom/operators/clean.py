"""Time-index cleaning: duplicates, order, frequency, grid, fill, periods."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import attach, filled, lagged, nearby, whole
from chronoloom.functions.steps import (
    DAY,
    SECOND,
    Step,
    advance,
    index_of,
    is_integer,
    month_number,
    step_struct,
    ticks,
)

# A gap longer than this many steps is generated in several pieces.
_RUN = 10_000


def dedupe(
    tsf: TimeSeriesFrame, ties: Iterable[str] | None = None, copies: str | None = None
) -> TimeSeriesFrame:
    """One row per (key, time): the first by the tie columns.

    A partial aggregate, so many copies of one time shrink before the shuffle. With
    `copies`, a column of that name counts the rows that were merged.
    """
    ties = list(tsf.ties if ties is None else ties)
    rest = [c for c in tsf.df.columns if c not in (*tsf.keys, tsf.time)]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    names = [*tsf.df.columns, *([copies] if copies else [])]
    order = [F.col(t) for t in ties] or [F.col(c) for c in rest if _orderable(tsf.df, c)]
    only = tsf.df.schema[ties[0]].dataType if len(ties) == 1 else None
    if isinstance(only, T.IntegralType):
        # A plain number as order keeps the aggregate a hash aggregate.
        first = F.coalesce(F.col(ties[0]).cast("bigint"), F.lit(2**63 - 1))
        picks = [F.min_by(c, first).alias(c) for c in rest]
        out = tsf.df.groupBy(*tsf.keys, tsf.time).agg(*picks, *counted)
    else:
        row = F.struct(*rest)
        out = tsf.df.groupBy(*tsf.keys, tsf.time).agg(
            F.min_by(row, F.struct(*order)).alias("__r"), *counted
        )
        out = out.select(*tsf.keys, tsf.time, "__r.*", *([copies] if copies else []))
    return tsf.with_df(out.select(*names))


def _orderable(df: DataFrame, column: str) -> bool:
    return not isinstance(df.schema[column].dataType, (T.MapType, T.VariantType))


def duplicate_counts(tsf: TimeSeriesFrame) -> DataFrame:
    """Rows, distinct times and surplus rows per series, in two partial aggregates."""
    per_time = tsf.df.groupBy(*tsf.keys, tsf.time).agg(F.count(F.lit(1)).alias("__c"))
    return per_time.groupBy(*tsf.keys).agg(
        F.sum("__c").alias("rows"),
        F.count(F.lit(1)).alias("times"),
        F.sum(F.col("__c") - 1).alias("duplicates"),
    )


def sortedness(tsf: TimeSeriesFrame, ingest: str) -> DataFrame:
    """Per series: does the time ever step back in ingest order? No data are sorted for keeps."""
    by_ingest = replace(
        tsf, time=ingest, target=tsf.time, ties=(), freq=None, span=None, cache={}
    )
    seen = lagged(by_ingest, {"__prev": (tsf.time, 1)}).df
    back = F.col("__prev") > F.col(tsf.time)
    return seen.groupBy(*tsf.keys).agg(
        F.coalesce(F.max(back), F.lit(False)).alias("was_unsorted"),
        F.count_if(back).alias("steps_back"),
    )


def _gap(tsf: TimeSeriesFrame) -> Column:
    """Distance in ticks to the row before, which is in `__prev`."""
    return ticks(F.col(tsf.time), tsf.time_type) - ticks(F.col("__prev"), tsf.time_type)


def frequency_stats(tsf: TimeSeriesFrame) -> dict[str, Column]:
    """Plain aggregates over rows that carry `__prev`."""
    dtype, now = tsf.time_type, F.col(tsf.time)
    stats = {
        "__rows": F.count(F.lit(1)),
        "__gap": F.min(_gap(tsf)),
        "__gap_hi": F.max(_gap(tsf)),
        "__same": F.count_if(_gap(tsf) == 0),
    }
    if is_integer(dtype):
        return stats
    months = month_number(now) - month_number(F.col("__prev"))
    time_of_day = F.pmod(ticks(now, dtype), F.lit(DAY))
    return stats | {
        "__months": F.min(months),
        "__months_hi": F.max(months),
        "__day": F.min(F.dayofmonth(now)),
        "__day_hi": F.max(F.dayofmonth(now)),
        "__time": F.min(time_of_day),
        "__time_hi": F.max(time_of_day),
        "__to_end": F.max(F.datediff(F.last_day(now), now)),
    }


def label_of(step: Column) -> Column:
    """Frequency label of a step struct."""
    months, size = step["months"], step["ticks"]
    start = F.when(step["month_end"], F.lit("E")).otherwise(F.lit("S"))

    def count(n: Column, unit: Column | str) -> Column:
        unit = F.lit(unit) if isinstance(unit, str) else unit
        return F.concat(F.when(n == 1, F.lit("")).otherwise(n.cast("bigint").cast("string")), unit)

    label = F.when(
        months > 0,
        F.when(months % 12 == 0, count(months / 12, F.concat(F.lit("Y"), start)))
        .when(months % 3 == 0, count(months / 3, F.concat(F.lit("Q"), start)))
        .otherwise(count(months, F.concat(F.lit("M"), start))),
    )
    for unit, ticks_ in (
        ("W", 7 * DAY),
        ("D", DAY),
        ("h", 3600 * SECOND),
        ("min", 60 * SECOND),
        ("s", SECOND),
        ("ms", 1000),
    ):
        label = label.when(size % ticks_ == 0, count(size / ticks_, unit))
    return label.otherwise(count(size, "us"))


def exact_step(dtype: T.DataType) -> Column:
    """Step struct when all gaps agree, else NULL; needs three points."""
    enough = F.col("__rows") >= 3
    same_gap = (F.col("__gap") == F.col("__gap_hi")) & (F.col("__gap") > 0)
    no = F.lit(False)
    fixed = step_struct(F.lit(0), F.col("__gap"), no)
    if is_integer(dtype):
        return F.when(enough & same_gap, fixed)
    monthly = (
        (F.col("__months") == F.col("__months_hi"))
        & (F.col("__months") > 0)
        & (F.col("__time") == F.col("__time_hi"))
        & ((F.col("__to_end") == 0) | (F.col("__day") == F.col("__day_hi")))
    )
    calendar = step_struct(F.col("__months"), F.lit(0), F.col("__to_end") == 0)
    return F.when(enough & same_gap, fixed).when(enough & monthly, calendar)


def with_previous_time(tsf: TimeSeriesFrame) -> TimeSeriesFrame:
    return lagged(tsf, {"__prev": (tsf.time, 1)})


def infer_frequency(tsf: TimeSeriesFrame) -> DataFrame:
    """`(keys…, rows, freq, step)` with the exact frequency of each series, or NULL."""
    stats = with_previous_time(tsf).df.groupBy(*tsf.keys).agg(
        *[a.alias(n) for n, a in frequency_stats(tsf).items()]
    )
    out = stats.withColumn("step", exact_step(tsf.time_type))
    label = F.when(F.col("step").isNull(), F.lit(None).cast("string"))
    label = label.otherwise(_label(tsf, F.col("step")))
    return out.select(*tsf.keys, F.col("__rows").alias("rows"), label.alias("freq"), "step")


def _label(tsf: TimeSeriesFrame, step: Column) -> Column:
    return F.lit("Integer") if is_integer(tsf.time_type) else label_of(step)


def modal_gap(tsf: TimeSeriesFrame) -> DataFrame:
    """`(keys…, gap, gap_rows)`: the most common gap in ticks, smallest on ties."""
    gapped = with_previous_time(tsf).df.where("__prev is not null")
    counts = gapped.groupBy(*tsf.keys, _gap(tsf).alias("gap")).agg(F.count(F.lit(1)).alias("gap_rows"))
    order = W.partitionBy(*tsf.keys).orderBy(F.desc("gap_rows"), F.asc("gap"))
    return counts.withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")


def modal_step(gap: Column, dtype: T.DataType) -> Column:
    """Step for the most common gap; 28 to 31 days count as a month."""
    fixed = step_struct(F.lit(0), gap, F.lit(False))
    if is_integer(dtype):
        return fixed
    days = F.call_function("div", gap, F.lit(DAY))
    return F.when(days.between(28, 31), step_struct(F.lit(1), F.lit(0), F.lit(False))).otherwise(fixed)


def modal_frequency(tsf: TimeSeriesFrame) -> DataFrame:
    """`(keys…, gap, gap_rows, freq, step)` from the most common gap."""
    out = modal_gap(tsf).withColumn("step", modal_step(F.col("gap"), tsf.time_type))
    return out.withColumn("freq", _label(tsf, F.col("step"))).select(
        *tsf.keys, "gap", "gap_rows", "freq", "step"
    )


def with_frequency(tsf: TimeSeriesFrame) -> TimeSeriesFrame:
    """Adds `__step` and `__freq` of each series to its rows: exact where it exists, else
    by the most common gap, else NULL.

    For series that fit a task everything is a window over the key, which shares one
    exchange with the steps that follow. Long series are counted per gap first.
    """
    gapped = with_previous_time(tsf)
    if not tsf.width:
        w = W.partitionBy(*tsf.keys)
        stats = {n: a.over(w) for n, a in frequency_stats(tsf).items()}
        # Smallest on ties.
        stats["__mode"] = F.mode(_gap(tsf), True).over(w)
        df = gapped.df.withColumns(stats)
        extra = [*stats, "__prev"]
    else:
        per_gap = gapped.df.groupBy(*tsf.keys, _gap(tsf).alias("__g")).agg(
            *[a.alias(n) for n, a in frequency_stats(tsf).items()]
        )
        merge = {n: F.max(n) if n.endswith("_hi") or n == "__to_end" else F.min(n) for n in frequency_stats(tsf)}
        merge |= {n: F.sum(n) for n in ("__rows", "__same")}
        known = F.when(F.col("__g").isNotNull(), F.struct("__rows", -F.col("__g")))
        merge["__mode"] = F.max_by("__g", known)
        table = per_gap.groupBy(*tsf.keys).agg(*[a.alias(n) for n, a in merge.items()])
        df, extra = attach(tsf, table).df, list(merge)
    modal = F.when(F.col("__mode") > 0, modal_step(F.col("__mode"), tsf.time_type))
    df = df.withColumn("__step", F.coalesce(exact_step(tsf.time_type), modal))
    label = F.when(F.col("__step").isNotNull(), _label(tsf, F.col("__step")))
    return tsf.with_df(df.withColumn("__freq", label).drop(*extra))


def _on_grid(tsf: TimeSeriesFrame, anchor: str) -> TimeSeriesFrame:
    """Rows with `__anchor`, `__k` and `__on` (is the time a grid point?).

    Expects a `__step` struct column; a NULL step means no grid for that series.
    """
    dtype, step = tsf.time_type, F.col("__step")
    if anchor == "calendar":
        first = whole(tsf, {"__first": F.min(tsf.time)})
        start = Step.parse(tsf.freq).floor(F.col("__first"), dtype)
        framed = first.with_df(first.df.withColumn("__anchor", start).drop("__first"))
    elif anchor == "start":
        framed = whole(tsf, {"__anchor": F.min(tsf.time)})
    else:
        raise ValueError("anchor must be 'start' or 'calendar'")
    k = F.when(step.isNull(), F.lit(0)).otherwise(index_of(F.col("__anchor"), step, tsf.ts, dtype))
    df = framed.df.withColumn("__k", k.cast("bigint"))
    point = advance(F.col("__anchor"), step, F.col("__k"), dtype)
    return tsf.with_df(df.withColumn("__on", step.isNull() | (point == tsf.ts)))


def _fill_grid(tsf: TimeSeriesFrame) -> TimeSeriesFrame:
    """Each on-grid row emits itself and the empty grid points up to the next row.

    No join with a generated grid: the one exchange is that of the series window.
    """
    dtype, step = tsf.time_type, F.col("__step")
    kept = tsf.with_df(tsf.df.where(F.col("__on") & tsf.ts.isNotNull()))
    nxt = nearby(kept, 0, 1, lambda w: {"__next": F.lead("__k", 1).over(w)})
    last = F.when(step.isNull(), F.col("__k")).otherwise(
        F.coalesce(F.col("__next") - 1, F.col("__k"))
    )
    df = nxt.df.withColumn("__last", F.greatest(last, F.col("__k")))
    # Two levels, so that one long gap never becomes one huge array.
    df = df.withColumn("__from", F.explode(F.sequence("__k", "__last", F.lit(_RUN).cast("bigint"))))
    df = df.withColumn(
        "__i", F.explode(F.sequence("__from", F.least(F.col("__from") + _RUN - 1, F.col("__last"))))
    )
    new = F.col("__i") > F.col("__k")
    time = F.when(new, advance(F.col("__anchor"), step, F.col("__i"), dtype)).otherwise(tsf.ts)
    cols = []
    for c in tsf.df.columns:
        if c in tsf.keys or c.startswith("__"):
            continue
        cols.append((time if c == tsf.time else F.when(~new, F.col(c))).alias(c))
    # Series are longer than before, so they are measured anew. Those that fitted a task have
    # at most as many rows as grid points, or as before where there is no step.
    bound = None if tsf.width else kept.df.agg((F.max("__k") + 1).alias("rows"))
    out = df.select(*tsf.keys, *cols, new.alias("__gap"))
    return tsf.with_df(out, cache={}, bound=bound)


def regular_grid(tsf: TimeSeriesFrame, freq: str | None = None, anchor="start") -> TimeSeriesFrame:
    """Complete grid from first to last time at the given frequency; values NULL in gaps.

    Rows off the grid are left out (see `off_grid_rows`); (key, time) must be unique.
    """
    step = Step.parse(freq or tsf.freq or tsf.step)
    base = replace(tsf, freq=step.label)
    base = base.with_df(base.df.withColumn("__step", step.columns()))
    out = _fill_grid(_on_grid(base, anchor))
    return out.with_df(out.df.drop("__gap"))


def off_grid_rows(tsf: TimeSeriesFrame, freq: str | None = None) -> DataFrame:
    """Rows per series that are no grid point counted from the first time."""
    step = Step.parse(freq or tsf.freq or tsf.step)
    base = tsf.with_df(tsf.df.withColumn("__step", step.columns()))
    marked = _on_grid(base, "start").df
    return marked.groupBy(*tsf.keys).agg(F.count_if(~F.col("__on")).alias("off_grid_rows"))


def fill_missing(
    tsf: TimeSeriesFrame, fill="both", cols: Iterable[str] | None = None
) -> TimeSeriesFrame:
    """Forward fill, then back fill; `ffill` alone avoids values from the future."""
    if fill not in ("both", "ffill", "bfill"):
        raise ValueError("fill must be 'both', 'ffill' or 'bfill'")
    cols = [tsf.target, *tsf.exog] if cols is None else list(cols)
    return filled(tsf, cols, forward=fill != "bfill", backward=fill != "ffill")


def to_period(tsf: TimeSeriesFrame, freq: str | None = None) -> TimeSeriesFrame:
    """Times moved to the start of their period; integer time is left alone."""
    if is_integer(tsf.time_type):
        return tsf
    step = Step.parse(freq) if freq else tsf.step
    return tsf.with_df(tsf.df.withColumn(tsf.time, step.floor(tsf.ts, tsf.time_type)))


def resample(
    tsf: TimeSeriesFrame, freq: str, agg="sum", exog: dict[str, str] | None = None
) -> TimeSeriesFrame:
    """One row per (key, period): sum, mean, min, max, count, first or last of the target."""
    step = Step.parse(freq)
    make = {
        "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count,
        "first": lambda c: F.min_by(c, F.col(tsf.time)),
        "last": lambda c: F.max_by(c, F.col(tsf.time)),
    }
    names = {tsf.target: agg, **(exog or {})}
    for kind in names.values():
        if kind not in make:
            raise ValueError(f"Unknown aggregate {kind!r}; use one of {list(make)}")
    period = step.floor(tsf.ts, tsf.time_type)
    df = tsf.df.groupBy(*tsf.keys, period.alias("__t")).agg(
        *[make[kind](F.col(c)).alias(c) for c, kind in names.items()]
    )
    df = df.withColumn(tsf.target, F.col(tsf.target).cast("double"))
    df = df.select(*tsf.keys, F.col("__t").alias(tsf.time), *names)
    return TimeSeriesFrame(
        df, tsf.keys, tsf.time, tsf.target, tuple(exog or ()), freq, (), tsf.max_rows,
        span=(tsf.df, tsf.time),
    )


def format_series(
    tsf: TimeSeriesFrame,
    infer_freq: bool = True,
    fill: str | None = "both",
    remove_duplicates: bool = True,
    ties: Iterable[str] | None = None,
    anchor: str = "start",
) -> tuple[TimeSeriesFrame, DataFrame]:
    """Duplicates, frequency and grid, fill, in that order; returns (frame, report).

    A frequency given on the frame is used for all series. Otherwise each series gets
    its own, and with `infer_freq=False` none. The input frame stays as it was.
    The report has one row per series. Rows without a time are left out of the frame and
    counted as `null_time_rows`.
    """
    keys = list(tsf.keys)
    if remove_duplicates:
        # Series that fit a task are spread by key once, which serves every later step.
        base = tsf if tsf.width else tsf.with_df(tsf.df.repartition(*keys))
        clean = dedupe(base, ties, copies="__copies")
    else:
        clean = tsf.with_df(tsf.df.withColumn("__copies", F.lit(1).cast("bigint")))
    if tsf.freq is not None:
        df = clean.df.withColumn("__step", tsf.step.columns())
        stepped = clean.with_df(df.withColumn("__freq", F.lit(tsf.freq)))
    elif infer_freq:
        stepped = with_frequency(clean)
    else:
        none = clean.df.withColumn("__freq", F.lit(None).cast("string"))
        stepped = clean.with_df(
            none.withColumn("__step", F.when(F.lit(False), Step("us", ticks=1).columns()))
        )
    marked = _on_grid(stepped, anchor)
    report = _format_report(marked, fill)
    out = _fill_grid(marked)
    out = out.with_df(out.df.drop("__gap"))
    if fill:
        out = fill_missing(out, fill)
    return out, report


def _format_report(marked: TimeSeriesFrame, fill: str | None) -> DataFrame:
    """One row per series. The grid need not be built to count it."""
    on, timed = F.col("__on"), marked.ts.isNotNull()
    stats = marked.df.groupBy(*marked.keys).agg(
        F.sum("__copies").alias("rows_in"),
        F.sum(F.when(timed, F.col("__copies") - 1).otherwise(0)).alias("duplicates_removed"),
        F.max("__freq").alias("frequency"),
        F.count_if(timed & ~on).alias("off_grid_rows"),
        F.sum(F.when(~timed, F.col("__copies")).otherwise(0)).alias("null_time_rows"),
        F.count_if(timed & on).alias("__kept"),
        F.max(F.when(F.col("__step").isNotNull() & on, F.col("__k") + 1)).alias("__points"),
        F.count_if(on & F.col(marked.target).isNull()).alias("__null"),
    )
    points = F.coalesce("__points", "__kept")
    gaps = points - F.col("__kept")
    filled_ = gaps + F.col("__null") if fill else F.lit(0).cast("bigint")
    return stats.select(
        *marked.keys, "rows_in", "duplicates_removed", "frequency", "off_grid_rows", "null_time_rows",
        points.alias("rows_out"), gaps.alias("gaps_filled"), filled_.alias("missing_filled"),
        F.col("frequency").isNotNull().alias("frequency_set"),
    )


def overlay(tsfs: list[TimeSeriesFrame], labels: list[str] | None = None) -> DataFrame:
    """Several series under a `label` column; missing labels become `Series N`."""
    if not tsfs:
        raise ValueError("Give at least one series")
    labels = list(labels or [])[: len(tsfs)]
    labels += [f"Series {i + 1}" for i in range(len(labels), len(tsfs))]
    kinds = {t.time_type.simpleString() for t in tsfs}
    out = None
    for name, t in zip(labels, tsfs):
        time = t.ts if len(kinds) == 1 else t.ts.cast("string")
        part = t.df.select(
            F.lit(name).alias("label"), *t.keys, time.alias("ts"), t.y.alias("y")
        )
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
