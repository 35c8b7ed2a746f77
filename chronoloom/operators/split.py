"""Temporal splits and cross-validation folds, as arithmetic on positions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import attach, null_safe_join, positions, running

# Folds of one series are generated in pieces of this many.
_PIECE = 10_000


@dataclass(frozen=True)
class Split:
    """Train and test frames; series that are too short are listed in `rejected`."""

    train: TimeSeriesFrame
    test: TimeSeriesFrame
    rejected: DataFrame
    marked: DataFrame

    def sizes(self) -> DataFrame:
        """Per series: train and test rows and the cutoff, the last train time."""
        t = self.train
        train = F.col("split") == "train"
        return self.marked.groupBy(*t.keys).agg(
            F.count_if(train).alias("train_size"),
            F.count_if(~train).alias("n_test"),
            F.max(F.when(train, F.col(t.time))).alias("cutoff"),
        )


def temporal_split(
    tsf: TimeSeriesFrame,
    test_size: float | None = None,
    fh: int | list[int] | None = None,
    strict: bool = False,
) -> Split:
    """Last rows of each series as test set: a fraction, or as many as the horizon needs."""
    if (test_size is None) == (fh is None):
        raise ValueError("Give exactly one of test_size and fh")
    if test_size is not None and not 0.0 < test_size < 1.0:
        raise ValueError(f"test_size must lie between 0 and 1, got {test_size}")
    if fh is not None:
        fh = [fh] if isinstance(fh, int) and not isinstance(fh, bool) else fh
        if not isinstance(fh, (list, tuple)) or not fh or any(
            not isinstance(h, int) or h < 1 for h in fh
        ):
            raise ValueError("fh must be a positive int or a non-empty list of them")
        want = F.lit(max(fh)).cast("bigint")
    else:
        want = F.greatest(F.lit(1), F.floor(F.col("__n") * F.lit(test_size)))
    df = positions(tsf, "__pos", "__n").df.withColumn("__test", want)
    short = F.col("__test") >= F.col("__n")
    if strict:
        message = F.concat(F.lit("Test set needs more rows than a series has: "), F.col("__n"))
        df = df.withColumn("__test", F.when(short, F.raise_error(message)).otherwise(F.col("__test")))
    fits = df.where(~short)
    side = F.when(F.col("__pos") >= F.col("__n") - F.col("__test"), F.lit("test"))
    marked = fits.withColumn("split", side.otherwise(F.lit("train"))).drop("__pos", "__n", "__test")
    rejected = df.where(short & (F.col("__pos") == 0)).select(
        *tsf.keys, F.col("__n").alias("n"), F.col("__test").cast("bigint").alias("n_test"),
        F.lit("test set as long as the series").alias("reason"),
    )
    return Split(
        tsf.with_df(marked.where("split = 'train'").drop("split")),
        tsf.with_df(marked.where("split = 'test'").drop("split")),
        rejected,
        marked,
    )


@dataclass(frozen=True)
class Folds:
    """Cross-validation folds. Fold i trains on positions before `end(i)`.

    `window` rows are used for training when given, else all of them; the test rows
    of fold i are `end(i) + h - 1` for every h in `fh`.
    """

    initial: int | None = None
    cv_folds: int | None = None
    step: int = 1
    window: int | None = None
    fh: tuple[int, ...] = (1,)

    def first_end(self, n: Column) -> Column:
        if self.initial is not None:
            return F.lit(self.initial).cast("bigint")
        return n - F.lit(max(self.fh) + (self.cv_folds - 1) * self.step)

    def last_end(self, n: Column) -> Column:
        return n - F.lit(max(self.fh))

    def count(self, n: Column) -> Column:
        span = self.last_end(n) - self.first_end(n)
        return F.when(
            (span >= 0) & (self.first_end(n) >= 1),
            F.call_function("div", span, F.lit(self.step)) + 1,
        ).otherwise(F.lit(0)).cast("bigint")

    def table(self, tsf: TimeSeriesFrame) -> DataFrame:
        """`(keys…, fold, train_start, train_end, n)`, positions with the end excluded."""
        sizes = tsf.df.groupBy(*tsf.keys).agg(F.count(F.lit(1)).alias("n"))
        counted = sizes.withColumn("__c", self.count(F.col("n"))).where("__c > 0")
        pieces = counted.withColumn(
            "__b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__c") - 1, F.lit(_PIECE).cast("bigint")))
        )
        folds = pieces.withColumn(
            "fold", F.explode(F.sequence("__b", F.least(F.col("__b") + _PIECE, F.col("__c")) - 1))
        )
        end = self.first_end(F.col("n")) + F.col("fold") * self.step
        start = F.greatest(F.lit(0), end - self.window) if self.window else F.lit(0)
        return folds.select(
            *tsf.keys, "fold", start.cast("bigint").alias("train_start"),
            end.cast("bigint").alias("train_end"), "n",
        )

    def expand(self, tsf: TimeSeriesFrame) -> DataFrame:
        """Every row once per fold that uses it: adds fold, role, pos and h (test only).

        A row works out its own folds from its position, so nothing is joined.
        """
        df = positions(tsf, "pos", "__n").df
        pos, n = F.col("pos"), F.col("__n")
        total, first, step = self.count(n), self.first_end(n), F.lit(self.step)
        zero = F.lit(0).cast("bigint")
        # Train: end > pos, and end - window <= pos when there is a window.
        lo = F.greatest(zero, F.call_function("div", pos - first + step, step))
        lo = F.when(pos < first, zero).otherwise(lo)
        hi = total - 1
        if self.window:
            reach = F.when(
                pos + self.window < first, F.lit(-1)
            ).otherwise(F.call_function("div", pos + self.window - first, step))
            hi = F.least(hi, reach)
        train = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
        parts = [F.transform(train, lambda f: F.struct(f.alias("fold"), F.lit("train").alias("role"), F.lit(0).alias("h")))]
        for h in self.fh:
            end = pos - (h - 1)
            f = F.call_function("div", end - first, step)
            hit = (end >= first) & (first + f * step == end) & (f < total)
            one = F.array(F.struct(f.alias("fold"), F.lit("test").alias("role"), F.lit(h).alias("h")))
            none = F.array().cast("array<struct<fold:bigint,role:string,h:int>>")
            parts.append(F.when(hit, one).otherwise(none))
        rows = df.where(total > 0).withColumn("__f", F.explode(F.concat(*parts)))
        return rows.select(*tsf.df.columns, "pos", "__f.fold", "__f.role", "__f.h")

    def counts(self, tsf: TimeSeriesFrame) -> DataFrame:
        """`(keys…, n_folds)` without listing the folds."""
        sizes = tsf.df.groupBy(*tsf.keys).agg(F.count(F.lit(1)).alias("n"))
        return sizes.select(*tsf.keys, self.count(F.col("n")).alias("n_folds"))


def expanding_folds(
    cv_folds: int = 3, initial_window: int | None = None, step: int = 1, fh=(1,)
) -> Folds:
    """Growing training window; the last `cv_folds` cutoffs, or all from `initial_window` on."""
    fh = _horizon(fh)
    if initial_window is not None:
        if initial_window < 1:
            raise ValueError(f"initial_window must be at least 1, got {initial_window}")
        return Folds(initial=initial_window, step=_positive(step, "step"), fh=fh)
    return Folds(cv_folds=_positive(cv_folds, "cv_folds"), step=_positive(step, "step"), fh=fh)


def sliding_folds(
    window_length: int, step: int = 1, fh=(1,), initial_window: int | None = None
) -> Folds:
    """Training window of fixed length that moves by `step`."""
    start = window_length if initial_window is None else initial_window
    return Folds(
        initial=_positive(start, "initial_window"), step=_positive(step, "step"),
        window=_positive(window_length, "window_length"), fh=_horizon(fh),
    )


def cutoff_folds(tsf: TimeSeriesFrame, cutoffs: DataFrame, fh=(1,)) -> DataFrame:
    """Folds at given times: `(keys…, cutoff, train_end, n)` from rows `(keys…, cutoff)`.

    The cutoffs are merged into the series as marker rows and counted with one running
    sum, instead of a range join of cutoffs with history. Cutoffs without `max(fh)`
    rows after them are dropped, as they have no test set.
    """
    fh = _horizon(fh)
    rows = tsf.df.select(*tsf.keys, tsf.time, F.lit(0).alias("__mark"))
    marks = cutoffs.select(
        *tsf.keys, F.col("cutoff").cast(tsf.time_type).alias(tsf.time), F.lit(1).alias("__mark")
    )
    both = tsf.with_df(rows.unionByName(marks), ties=("__mark",), span=None, cache={})
    seen = running(both, {"train_end": ("count", F.when(F.col("__mark") == 0, F.lit(1)))})
    sizes = tsf.df.groupBy(*tsf.keys).agg(F.count(F.lit(1)).alias("n"))
    out = null_safe_join(seen.df.where("__mark = 1"), sizes, tsf.keys)
    out = out.where(F.col("n") - F.col("train_end") >= max(fh)).where("train_end > 0")
    return out.select(*tsf.keys, F.col(tsf.time).alias("cutoff"), "train_end", "n")


def cutoff_rows(tsf: TimeSeriesFrame, cutoffs: DataFrame, fh=(1,)) -> DataFrame:
    """Rows of each cutoff fold with role train or test and the horizon of test rows."""
    folds = cutoff_folds(tsf, cutoffs, fh)
    listed = folds.groupBy(*tsf.keys).agg(
        F.collect_list(F.struct("cutoff", "train_end")).alias("__folds")
    )
    df = attach(positions(tsf, "pos", None), listed).df
    used = F.filter(
        "__folds",
        lambda f: (F.col("pos") < f["train_end"])
        | (F.col("pos") - f["train_end"] + 1).isin(list(_horizon(fh))),
    )
    df = df.withColumn("__f", F.explode(used))
    train = F.col("pos") < F.col("__f.train_end")
    return df.select(
        *tsf.df.columns, "pos", F.col("__f.cutoff").alias("cutoff"),
        F.when(train, F.lit("train")).otherwise(F.lit("test")).alias("role"),
        F.when(train, F.lit(0)).otherwise(F.col("pos") - F.col("__f.train_end") + 1).cast("int").alias("h"),
    )


def history_at(tsf: TimeSeriesFrame, cutoffs: DataFrame) -> DataFrame:
    """What each cutoff can see: count, sum and mean of the rows before it.

    The expanding-window range join (`time < cutoff`) as a merge and a running sum.
    """
    rows = tsf.df.select(*tsf.keys, tsf.time, tsf.y.alias("__y"), F.lit(1).alias("__mark"))
    marks = cutoffs.select(
        *tsf.keys, F.col("cutoff").cast(tsf.time_type).alias(tsf.time),
        F.lit(None).cast("double").alias("__y"), F.lit(0).alias("__mark"),
    )
    both = tsf.with_df(rows.unionByName(marks), ties=("__mark",), span=None, cache={})
    seen = running(
        both,
        {
            "rows_before": ("count", F.when(F.col("__mark") == 1, F.lit(1))),
            "__s": ("sum", F.col("__y")),
            "__c": ("count", F.col("__y")),
        },
    ).df.where("__mark = 0")
    return seen.select(
        *tsf.keys, F.col(tsf.time).alias("cutoff"), "rows_before",
        (F.col("__s") / F.nullif(F.col("__c"), F.lit(0))).alias("mean_before"),
    )


def _positive(value: int, name: str) -> int:
    if not isinstance(value, int) or value < 1:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")
    return value


def _horizon(fh) -> tuple[int, ...]:
    fh = (fh,) if isinstance(fh, int) else tuple(fh)
    if not fh or any(not isinstance(h, int) or h < 1 for h in fh):
        raise ValueError("fh must hold positive integers")
    return fh
