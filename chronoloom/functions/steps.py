"""Time steps and tick arithmetic, all as JVM-side column expressions.

A step is either a fixed number of ticks (microseconds for timestamps, plain
units for integer time) or a number of calendar months.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000
DAY = 86_400 * SECOND

# Frequency labels and their size in ticks or months.
TICKS = {
    "us": 1,
    "ms": 1_000,
    "s": SECOND,
    "min": 60 * SECOND,
    "h": 3_600 * SECOND,
    "D": DAY,
    "W": 7 * DAY,
}
MONTHS = {"M": 1, "MS": 1, "ME": 1, "Q": 3, "QS": 3, "QE": 3, "Y": 12, "YS": 12, "YE": 12}

# Monday 1969-12-29, the week boundary before the epoch.
_WEEK_OFFSET = -3 * DAY


@dataclass(frozen=True)
class Step:
    """One regular step: `months` calendar months, or `ticks` when months is 0."""

    label: str
    months: int = 0
    ticks: int = 0
    month_end: bool = False

    @staticmethod
    def parse(label: str | "Step") -> "Step":
        if isinstance(label, Step):
            return label
        found = re.fullmatch(r"(\d*)([A-Za-z]*)", label.strip())
        if not found or not label.strip():
            raise ValueError(f"Unknown frequency {label!r}")
        count, unit = int(found[1] or 1), found[2]
        if count < 1:
            raise ValueError(f"Frequency {label!r} must be positive")
        if unit in ("", "Integer"):
            return Step(label, ticks=count)
        if unit in TICKS:
            return Step(label, ticks=count * TICKS[unit])
        if unit in MONTHS:
            return Step(label, months=count * MONTHS[unit], month_end=unit.endswith("E"))
        raise ValueError(f"Unknown frequency {label!r}; use one of {[*TICKS, *MONTHS]}")

    def columns(self) -> Column:
        """The step as a struct column, so that it can also differ per series."""
        return step_struct(
            F.lit(self.months), F.lit(self.ticks).cast("bigint"), F.lit(self.month_end)
        )

    def floor(self, ts: Column, dtype: T.DataType) -> Column:
        """Start of the period that holds `ts`."""
        if self.months:
            unit = {1: "MM", 3: "quarter", 12: "year"}.get(self.months)
            if unit is None:
                raise ValueError(f"Cannot truncate to {self.label!r}")
            return F.trunc(ts, unit).cast(dtype)
        if self.ticks == DAY:
            return F.to_date(ts).cast(dtype)
        shift = _WEEK_OFFSET if self.ticks % (7 * DAY) == 0 and not is_integer(dtype) else 0
        size = F.lit(self.ticks).cast("bigint")
        offset = F.pmod(ticks(ts, dtype) - F.lit(shift).cast("bigint"), size)
        return move(ts, -offset, dtype)


def is_integer(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.IntegralType)


def step_struct(months: Column, ticks_: Column, month_end: Column) -> Column:
    return F.struct(
        months.cast("int").alias("months"),
        ticks_.cast("bigint").alias("ticks"),
        month_end.alias("month_end"),
    )


def ticks(ts: Column, dtype: T.DataType) -> Column:
    """Time as BIGINT: microseconds since the epoch, or the integer itself."""
    if is_integer(dtype):
        return ts.cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(ts)
    # Exact for TIMESTAMP_NTZ in a session without clock changes, such as UTC.
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def move(ts: Column, n: Column, dtype: T.DataType) -> Column:
    """`ts` moved by n ticks."""
    if is_integer(dtype):
        return (ts + n).cast(dtype)
    return F.timestamp_add("MICROSECOND", n, ts)


def advance(anchor: Column, step: Column, k: Column, dtype: T.DataType) -> Column:
    """The k-th grid point after `anchor`; month ends clamp, and ME steps stay on them."""
    fixed = move(anchor, step["ticks"] * k, dtype)
    if is_integer(dtype):
        return fixed
    calendar = F.timestamp_add("MONTH", (step["months"] * k).cast("int"), anchor)
    to_month_end = F.datediff(F.last_day(calendar), calendar)
    at_end = F.timestamp_add("DAY", to_month_end, calendar)
    return F.when(step["months"] == 0, fixed).otherwise(
        F.when(step["month_end"], at_end).otherwise(calendar)
    )


def month_number(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def index_of(anchor: Column, step: Column, ts: Column, dtype: T.DataType) -> Column:
    """Number of whole steps from `anchor` to `ts`; compare with `advance` for exactness."""
    whole = whole_steps(ticks(ts, dtype) - ticks(anchor, dtype), step["ticks"])
    if is_integer(dtype):
        return whole
    months = whole_steps(month_number(ts) - month_number(anchor), step["months"])
    return F.when(step["months"] == 0, whole).otherwise(months)


def whole_steps(distance: Column, size: Column) -> Column:
    """Integer division in BIGINT; NULL where the step has no such unit."""
    return F.call_function("div", distance.cast("bigint"), F.nullif(size.cast("bigint"), F.lit(0)))


def floor_div(value: Column, size: int) -> Column:
    """Integer division that rounds down, also below zero."""
    size = F.lit(size).cast("bigint")
    return F.call_function("div", value - F.pmod(value, size), size)
