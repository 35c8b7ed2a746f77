"""TimeSeriesFrame: a lazy DataFrame plus the roles of its columns."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.steps import DAY, Step, floor_div, is_integer, ticks

# Rows of one series that a single task may hold. Longer series are cut into time
# chunks (see functions/ordered.py).
MAX_SERIES_ROWS = 1_000_000

# Column names taken for the time column when none is given.
TIME_NAMES = ("date", "time", "datetime", "timestamp", "ds", "period")

TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


@dataclass(frozen=True)
class TimeSeriesFrame:
    """Long rows `(keys…, time, target, exog…)`; one series per key.

    `measure` caches how series must be cut: width 0 means that every series was
    measured to fit one task, a positive width is the chunk size in ticks. `bound`, if
    given, has one row with a number that no series has more rows than.
    """

    df: DataFrame
    keys: tuple[str, ...]
    time: str
    target: str
    exog: tuple[str, ...] = ()
    freq: str | None = None
    ties: tuple[str, ...] = ()
    max_rows: int = MAX_SERIES_ROWS
    span: tuple[DataFrame, str] | None = None
    bound: DataFrame | None = None
    cache: dict = field(default_factory=dict, compare=False, repr=False)

    @property
    def time_type(self) -> T.DataType:
        return self.df.schema[self.time].dataType

    @property
    def y(self) -> Column:
        return F.col(self.target)

    @property
    def ts(self) -> Column:
        return F.col(self.time)

    @property
    def step(self) -> Step:
        if self.freq is None:
            raise ValueError("This operator needs a frequency; give freq= or run format_series first")
        return Step.parse(self.freq)

    def with_df(self, df: DataFrame, **changes) -> "TimeSeriesFrame":
        """Same roles over another DataFrame whose series are not longer than before."""
        return replace(self, df=df, **changes)

    def columns(self) -> list[str]:
        return [*self.keys, self.time, self.target, *self.exog]

    @property
    def width(self) -> int:
        """Chunk width in ticks; 0 when every series fits one task. Measured once."""
        if "width" not in self.cache:
            self.cache["width"] = _measure(self)
        return self.cache["width"]


def _measure(tsf: TimeSeriesFrame) -> int:
    if tsf.span is not None and tsf.freq is not None:
        return _measure_by_span(tsf)
    if tsf.bound is not None and (tsf.bound.first()[0] or 0) <= tsf.max_rows:
        return 0
    position = ticks(F.col(tsf.time), tsf.time_type)
    bucket = 1 << 20 if is_integer(tsf.time_type) else DAY
    limit, width = tsf.max_rows, 0
    while True:
        piece = floor_div(position, width or bucket)
        per_bucket = tsf.df.groupBy(*tsf.keys, piece.alias("__b")).agg(
            F.count(F.lit(1)).alias("n")
        )
        top = (
            per_bucket.groupBy(*tsf.keys)
            .agg(F.sum("n").alias("rows"), F.max("n").alias("dense"))
            .agg(F.max("rows"), F.max("dense"))
            .first()
        )
        rows, dense = top[0] or 0, top[1] or 0
        if rows <= limit:
            return 0
        if width and (dense <= limit or width == 1):
            return width
        # Scale the bucket so that the densest one holds at most half the limit.
        width = max(1, int((width or bucket) * limit / (2 * dense)))
        if not is_integer(tsf.time_type):
            width = min(width, 36_500 * DAY)


def _measure_by_span(tsf: TimeSeriesFrame) -> int:
    """At most one row per key and step: first and last time bound the series length."""
    source, column = tsf.span
    dtype = source.schema[column].dataType
    bounds = source.agg(
        ticks(F.min(column), dtype).alias("lo"), ticks(F.max(column), dtype).alias("hi")
    ).first()
    step = tsf.step
    size = step.ticks or step.months * 28 * DAY
    rows = 0 if bounds["lo"] is None else (bounds["hi"] - bounds["lo"]) // size + 1
    return 0 if rows <= tsf.max_rows else tsf.max_rows * size


def detect_time_column(schema: T.StructType) -> str | None:
    """First column, in order, with a time-like name or a time type."""
    for f in schema.fields:
        if f.name.lower() in TIME_NAMES or isinstance(f.dataType, TIME_TYPES):
            return f.name
    return None


def _require(columns: Iterable[str], name: str, role: str) -> None:
    if name not in columns:
        raise ValueError(f"{role} column '{name}' not found; available: {list(columns)}")


def parse_time(df: DataFrame, column: str) -> DataFrame:
    """Time column as TIMESTAMP_NTZ, TIMESTAMP or BIGINT; bad text fails the job."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        parsed = F.try_to_timestamp(F.col(column)).cast("timestamp_ntz")
        bad = F.col(column).isNotNull() & parsed.isNull()
        message = F.concat(F.lit(f"Column '{column}' is not a time: "), F.col(column))
        return df.withColumn(
            column, F.when(bad, F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed)
        )
    if isinstance(dtype, T.DateType):
        return df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    if isinstance(dtype, T.IntegralType):
        return df.withColumn(column, F.col(column).cast("bigint"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return df
    raise ValueError(f"Time column '{column}' has type {dtype.simpleString()}; give text, time or int")


def with_roles(
    df: DataFrame,
    keys: Iterable[str] = (),
    time_col: str | None = None,
    target: str | None = None,
    exog: Iterable[str] | None = None,
    freq: str | None = None,
    ties: Iterable[str] = (),
    max_rows: int = MAX_SERIES_ROWS,
) -> TimeSeriesFrame:
    """Give columns their roles.

    With no `exog`, all other columns are exogenous; listed names that do not exist
    are dropped. With no `target`, the first value column is the target. With no
    `keys`, the whole frame is one series under the constant key `series`.
    """
    keys, ties = tuple(keys), tuple(ties)
    for k in keys:
        _require(df.columns, k, "Key")
    if time_col is None:
        time_col = detect_time_column(df.schema)
        if time_col is None:
            raise ValueError(f"No time column found; available: {df.columns}")
    _require(df.columns, time_col, "Time")
    values = [c for c in df.columns if c not in keys and c != time_col]
    if target is None:
        if not values:
            raise ValueError(f"No target column left; available: {df.columns}")
        target = values[0]
    _require(df.columns, target, "Target")
    if exog is None:
        extra = tuple(c for c in values if c != target)
    else:
        extra = tuple(c for c in exog if c in values and c != target)
    keep = dict.fromkeys([*keys, time_col, target, *extra, *(t for t in ties if t in df.columns)])
    out = parse_time(df.select(*keep), time_col)
    if isinstance(out.schema[target].dataType, T.NumericType):
        number = F.col(target).cast("double")
        out = out.withColumn(target, F.when(~F.isnan(number), number))
    if not keys:
        out, keys = out.withColumn("series", F.lit("all")), ("series",)
    if freq is not None:
        Step.parse(freq)
    return TimeSeriesFrame(out, keys, time_col, target, extra, freq, ties, max_rows)
