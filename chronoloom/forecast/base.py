"""Common shape of all forecasters: fit gives a parameter table, forecast reads it."""

from __future__ import annotations

from collections.abc import Iterable
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import null_safe_join
from chronoloom.functions.steps import advance

DEFAULT_HORIZON = 12


def check_horizon(horizon) -> int:
    if isinstance(horizon, bool) or not isinstance(horizon, int) or horizon < 1:
        raise ValueError(f"horizon must be a positive integer, got {horizon!r}")
    return horizon


def keys_of(params: DataFrame) -> list[str]:
    """Series keys are the columns before `cutoff`."""
    if "cutoff" not in params.columns:
        raise ValueError("Not a parameter table; fit a forecaster first")
    return params.columns[: params.columns.index("cutoff")]


def levels(values: float | Iterable[float], name: str) -> list[float]:
    values = [values] if isinstance(values, (int, float)) else list(values)
    if not values or any(not 0.0 < float(v) < 1.0 for v in values):
        raise ValueError(f"{name} must lie between 0 and 1, got {values}")
    return [float(v) for v in values]


def future(params: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
    """Parameter rows repeated for steps 1..horizon, with the time of each step."""
    horizon = check_horizon(horizon)
    dtype = params.schema["cutoff"].dataType
    out = params.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    ts = advance(F.col("cutoff"), F.col("step"), F.col("h").cast("bigint"), dtype)
    return out.withColumn("ts", ts)


class Forecaster:
    """Base class. `params` columns: keys…, cutoff, step, n, then those of the model.

    Rows with a NULL target are left out before fitting, so fill gaps first.
    With `residuals=True`, fit adds `sse` and `dof`, which the interval methods need.
    """

    def rows(self, tsf: TimeSeriesFrame, residuals: bool) -> DataFrame:
        """Rows to aggregate; models that look at neighbours add columns here."""
        return tsf.df

    def aggregates(self, tsf: TimeSeriesFrame) -> dict[str, Column]:
        raise NotImplementedError

    def sse(self, tsf: TimeSeriesFrame) -> Column:
        """Sum of squared in-sample errors, as an aggregate."""
        raise NotImplementedError(f"{type(self).__name__} has no intervals")

    def dof(self, n: Column) -> Column:
        return n - 1

    def point(self) -> Column:
        """Forecast from parameter columns and `h`."""
        raise NotImplementedError

    def spread(self) -> Column:
        """Factor on the residual variance at step `h`."""
        raise NotImplementedError(f"{type(self).__name__} has no intervals")

    def finish(self, params: DataFrame) -> DataFrame:
        return params

    def fit(self, tsf: TimeSeriesFrame, residuals: bool = False) -> DataFrame:
        known = tsf.with_df(tsf.df.where(tsf.y.isNotNull()))
        aggs = {"cutoff": F.max(tsf.time), "n": F.count(tsf.y), **self.aggregates(known)}
        if residuals:
            aggs["sse"] = self.sse(known)
        params = (
            self.rows(known, residuals)
            .groupBy(*tsf.keys)
            .agg(*[a.alias(name) for name, a in aggs.items()])
        )
        params = params.withColumn("step", tsf.step.columns())
        if residuals:
            params = params.withColumn("dof", self.dof(F.col("n")).cast("bigint"))
        fixed = [*tsf.keys, "cutoff", "step", "n"]
        ordered = params.select(*fixed, *[c for c in params.columns if c not in fixed])
        return self.finish(ordered)

    def forecast(self, params: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
        keys = keys_of(params)
        return future(params, horizon).select(*keys, "ts", "h", self.point().alias("yhat"))

    def distribution(self, params: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
        """Normal forecast `(keys…, ts, h, mu, sigma)`."""
        if "sse" not in params.columns:
            raise ValueError("Fit with residuals=True to get intervals")
        variance = F.col("sse") / F.nullif(F.greatest(F.col("dof"), F.lit(0)), F.lit(0))
        sigma = F.sqrt(variance * self.spread())
        return future(params, horizon).select(
            *keys_of(params), "ts", "h", self.point().alias("mu"), sigma.alias("sigma")
        )

    def variance(self, params: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
        dist = self.distribution(params, horizon)
        return dist.select(
            *keys_of(params), "ts", "h", (F.col("sigma") * F.col("sigma")).alias("variance")
        )

    def intervals(
        self, params: DataFrame, horizon: int = DEFAULT_HORIZON, coverage=0.9
    ) -> DataFrame:
        """Lower and upper bound per coverage, as `lower_90`, `upper_90`, …"""
        cols = []
        for c in levels(coverage, "coverage"):
            z, name = NormalDist().inv_cdf(0.5 + c / 2), f"{c * 100:g}".replace(".", "_")
            cols.append((F.col("mu") - z * F.col("sigma")).alias(f"lower_{name}"))
            cols.append((F.col("mu") + z * F.col("sigma")).alias(f"upper_{name}"))
        return self.distribution(params, horizon).select(*keys_of(params), "ts", "h", *cols)

    def quantiles(self, params: DataFrame, horizon: int = DEFAULT_HORIZON, alpha=0.5) -> DataFrame:
        """One column per quantile, as `q_5`, `q_95`, …"""
        cols = [
            (F.col("mu") + NormalDist().inv_cdf(a) * F.col("sigma")).alias(
                f"q_{a * 100:g}".replace(".", "_")
            )
            for a in levels(alpha, "alpha")
        ]
        return self.distribution(params, horizon).select(*keys_of(params), "ts", "h", *cols)

    def merged(self) -> dict[str, Column]:
        """Model columns of an updated table from `o` (old) and `m` (new) structs.

        With an `sse` among them, a table fitted with residuals keeps its residual columns.
        """
        raise NotImplementedError(f"{type(self).__name__} cannot be updated; fit it again")

    def check_later(self, params: DataFrame, new: TimeSeriesFrame) -> None:
        """Raises unless there are new rows and all are later than what their series was fitted on."""
        keys = keys_of(params)
        ends = params.select(*keys, F.col("cutoff").alias("__end"))
        times = new.df.select(*keys, F.col(new.time).alias("__at"))
        late = F.coalesce(F.col("__at") > F.col("__end"), F.lit(True))
        found = null_safe_join(times, ends, keys, "left").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(~late).alias("early")
        ).first()
        if not found.n:
            raise ValueError("update needs new rows")
        if found.early:
            raise ValueError(f"update needs later rows; {found.early} are not after the cutoff of their series")

    def update(self, params: DataFrame, new: TimeSeriesFrame) -> DataFrame:
        """Parameters after more rows, without the old rows.

        The old table is not touched, so a failed update leaves it as it was. Series
        only in one of the two sides are kept. Rows that are not later than the cutoff of their
        series are refused. Residual columns are carried over where the state has all they need.
        """
        self.check_later(params, new)
        keys = keys_of(params)
        merged = self.merged()
        spread = "sse" in params.columns and "sse" in merged
        late = self.fit(new, residuals=spread)
        old = params.select(*keys, F.struct(*[c for c in params.columns if c not in keys]).alias("o"))
        add = late.select(*keys, F.struct(*[c for c in late.columns if c not in keys]).alias("m"))
        renamed = add.select(*[F.col(k).alias(f"__{k}") for k in keys], "m")
        same = None
        for k in keys:
            equal = old[k].eqNullSafe(renamed[f"__{k}"])
            same = equal if same is None else same & equal
        both = old.join(renamed, same, "full")
        one_side = F.coalesce
        fixed = {
            "cutoff": F.greatest("o.cutoff", "m.cutoff"),
            "step": one_side(F.col("o.step"), F.col("m.step")),
            "n": F.coalesce("o.n", F.lit(0)) + F.coalesce("m.n", F.lit(0)),
        }
        if spread:
            merged["dof"] = self.dof(fixed["n"]).cast("bigint")
        else:
            merged.pop("sse", None)
        out = []
        for name, value in {**fixed, **merged}.items():
            known_both = F.col("o").isNotNull() & F.col("m").isNotNull()
            alone = one_side(F.col(f"o.{name}"), F.col(f"m.{name}"))
            out.append(F.when(known_both, value).otherwise(alone).alias(name))
        owner = F.col("o").isNotNull()
        return both.select(
            *[F.when(owner, F.col(k)).otherwise(F.col(f"__{k}")).alias(k) for k in keys], *out
        )

    def rolling(self, tsf: TimeSeriesFrame, fh: tuple[int, ...], window: int | None):
        """`tsf` with `pos`, `n` and `yhat_<h>` from all earlier rows in one pass, or None."""
        return None

    def rolling_normal(self, tsf: TimeSeriesFrame, fh: tuple[int, ...], window: int | None):
        """`rolling` with `sigma_<h>` beside each `yhat_<h>`, or None."""
        return None


def save_params(params: DataFrame, path: str, overwrite: bool = False) -> None:
    keys_of(params)
    params.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    params = spark.read.parquet(path)
    keys_of(params)
    return params


def join_actuals(forecast: DataFrame, tsf: TimeSeriesFrame) -> DataFrame:
    """Forecast rows with the actual value of the same series and time."""
    actual = tsf.df.select(*tsf.keys, F.col(tsf.time).alias("ts"), tsf.y.alias("y"))
    return null_safe_join(forecast, actual, [*tsf.keys, "ts"])
