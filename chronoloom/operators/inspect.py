"""Inspection: validation, description, extent, structure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import head_rows, null_safe_join
from chronoloom.functions.quantiles import with_quantiles
from chronoloom.operators.clean import (
    exact_step, frequency_stats, infer_frequency, sortedness, with_previous_time,
)


def head(tsf: TimeSeriesFrame, n: int = 5) -> DataFrame:
    """First n rows of each series in time order."""
    return head_rows(tsf, n).select(*tsf.columns())


def missing(tsf: TimeSeriesFrame) -> DataFrame:
    """NULLs per series and value column, with the total."""
    cols = [tsf.target, *tsf.exog]
    parts = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in cols]
    out = tsf.df.groupBy(*tsf.keys).agg(F.count(F.lit(1)).alias("rows"), *parts)
    total = sum((F.col(f"missing_{c}") for c in cols), F.lit(0).cast("bigint"))
    return out.withColumn("missing_total", total)


def extent(tsf: TimeSeriesFrame) -> DataFrame:
    """Rows, first and last time (the cutoff) per series."""
    return tsf.df.groupBy(*tsf.keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(tsf.time).alias("start"),
        F.max(tsf.time).alias("cutoff"),
    )


def frequency_label(tsf: TimeSeriesFrame, previous: DataFrame | None = None) -> DataFrame:
    """Inferred label, else the declared one, else one known from before."""
    out = infer_frequency(tsf).select(*tsf.keys, F.col("freq").alias("inferred"))
    options = [F.col("inferred"), F.lit(tsf.freq).cast("string")]
    if previous is not None:
        known = previous.select(*tsf.keys, F.col("freq").alias("__known"))
        out = null_safe_join(out, known, tsf.keys, "left")
        options.append(F.col("__known"))
    return out.withColumn("freq", F.coalesce(*options)).select(*tsf.keys, "freq")


def constants(tsf: TimeSeriesFrame) -> DataFrame:
    """Per series and value column: exactly one distinct value that is not NULL?"""
    cols = [tsf.target, *tsf.exog]
    # min = max says "one distinct value" without a distinct aggregate.
    return tsf.df.groupBy(*tsf.keys).agg(
        *[
            F.coalesce(F.min(c) == F.max(c), F.lit(False)).alias(f"constant_{c}")
            for c in cols
        ]
    )


def describe(tsf: TimeSeriesFrame) -> DataFrame:
    """count, mean, std (n-1), min, quartiles, max of the target per series."""
    out = with_quantiles(
        tsf,
        tsf.df,
        {
            "count": F.count(tsf.y), "mean": F.avg(tsf.y), "std": F.stddev_samp(tsf.y),
            "min": F.min(tsf.y), "max": F.max(tsf.y),
        },
        [0.25, 0.5, 0.75],
    )
    return out.select(
        *tsf.keys, "count", "mean", "std", "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max",
    )


def structure(tsf: TimeSeriesFrame) -> DataFrame:
    """One row per column: name as shown, role, type, rows of the frame, scitype."""
    roles = [(k, "key", k) for k in tsf.keys] + [(tsf.time, "time", tsf.time)]
    roles += [(tsf.target, "target", tsf.target)]
    roles += [(c, "exog", f"X:{c}") for c in tsf.exog]
    single = tsf.keys == ("series",)
    scitype = "Series" if single else "Panel" if len(tsf.keys) == 1 else "Hierarchical"
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(shown).alias("column"),
                F.lit(role).alias("role"),
                F.lit(tsf.df.schema[c].dataType.simpleString()).alias("dtype"),
                F.lit(scitype).alias("scitype"),
            )
            for i, (c, role, shown) in enumerate(roles)
        ]
    )
    counted = tsf.df.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.explode(entries).alias("e"), "rows").select("e.*", "rows")


def validate(tsf: TimeSeriesFrame, ingest: str | None = None) -> DataFrame:
    """`(keys…, check, severity, value)`, one row per failed check and series.

    Checks: empty, missing_pct, duplicate_times, unsorted (with an ingest column),
    short (< 10 rows), not_numeric, constant, no_frequency.
    """
    keys = list(tsf.keys)
    cols = [tsf.target, *tsf.exog]
    table = with_previous_time(tsf).df.groupBy(*keys).agg(
        *[a.alias(n) for n, a in frequency_stats(tsf).items()],
        *[F.count_if(F.col(c).isNull()).alias(f"__m{i}") for i, c in enumerate(cols)],
        *[(F.min(c) == F.max(c)).alias(f"__c{i}") for i, c in enumerate(cols)],
    )
    table = table.withColumnRenamed("__rows", "__n").withColumnRenamed("__same", "duplicates")
    table = table.withColumn("__rows", F.col("__n")).withColumn("freq", exact_step(tsf.time_type))
    numeric = isinstance(tsf.df.schema[tsf.target].dataType, T.NumericType)
    checks = []

    def check(name, failed, value):
        checks.append(
            F.when(
                failed,
                F.struct(
                    F.lit(name).alias("check"),
                    F.lit("warning").alias("severity"),
                    value.cast("double").alias("value"),
                ),
            )
        )

    for i, c in enumerate(cols):
        check(
            f"missing_pct:{c}", F.col(f"__m{i}") > 0,
            F.round(F.col(f"__m{i}") / F.col("__n") * 100, 2),
        )
        check(f"constant:{c}", F.col(f"__c{i}"), F.lit(1.0))
    check("duplicate_times", F.col("duplicates") > 0, F.col("duplicates"))
    check("short", F.col("__n") < 10, F.col("__n"))
    if not numeric:
        check("not_numeric", F.lit(True), F.lit(1.0))
    if ingest is not None:
        table = null_safe_join(table, sortedness(tsf, ingest), keys)
        check("unsorted", F.col("was_unsorted"), F.col("steps_back"))
    check("no_frequency", (F.col("__n") >= 3) & F.col("freq").isNull(), F.lit(1.0))
    found = table.select(*keys, F.explode(F.array_compact(F.array(*checks))).alias("c"))
    found = found.select(*keys, "c.*")
    nothing = tsf.df.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        *[F.lit(None).cast(tsf.df.schema[k].dataType).alias(k) for k in keys],
        F.lit("empty").alias("check"), F.lit("error").alias("severity"), F.lit(0.0).alias("value"),
    )
    return found.unionByName(nothing)


def is_valid(report: DataFrame) -> DataFrame:
    """One row: no check of severity error failed."""
    return report.agg((F.count_if(F.col("severity") == "error") == 0).alias("valid"))
