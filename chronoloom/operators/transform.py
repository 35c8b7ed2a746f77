"""Transformers with an inverse, features and lags."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.forecast.base import DEFAULT_HORIZON, Forecaster, keys_of
from chronoloom.forecast.trend import Trend
from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import attach, lagged, nearby, null_safe_join, positions
from chronoloom.functions.quantiles import with_quantiles
from chronoloom.shared import cut_lineage


class Transformer:
    """fit gives one row of parameters per series (`keys…, p STRUCT`)."""

    def fit(self, tsf: TimeSeriesFrame) -> DataFrame:
        raise NotImplementedError

    def forward(self, y: Column, at: Column) -> Column:
        """New value of `y` at position `at`, from the struct `p`."""
        raise NotImplementedError

    def backward(self, y: Column, at: Column) -> Column:
        raise NotImplementedError

    def _apply(self, tsf: TimeSeriesFrame, params: DataFrame, op) -> TimeSeriesFrame:
        placed = attach(positions(tsf, "__at", None), params)
        df = placed.df.withColumn(tsf.target, op(tsf.y, F.col("__at")))
        return tsf.with_df(df.drop("__at", "p"))

    def transform(self, tsf: TimeSeriesFrame, params: DataFrame) -> TimeSeriesFrame:
        return self._apply(tsf, params, self.forward)

    def inverse(self, tsf: TimeSeriesFrame, params: DataFrame) -> TimeSeriesFrame:
        return self._apply(tsf, params, self.backward)


class Detrend(Transformer):
    """Takes away the least-squares line."""

    def fit(self, tsf):
        params = Trend().fit(tsf)
        return params.select(*tsf.keys, F.struct("intercept", "slope").alias("p"))

    def forward(self, y, at):
        return y - (F.col("p.intercept") + F.col("p.slope") * at)

    def backward(self, y, at):
        return y + (F.col("p.intercept") + F.col("p.slope") * at)


class Deseasonalise(Transformer):
    """Classical decomposition: centred moving average, slot means, normalised.

    Slots are positions modulo `sp`. Additive indices sum to 0, multiplicative ones
    average 1. A series under two seasons gets neutral indices.
    """

    def __init__(self, sp: int, model: str = "additive"):
        if sp < 2:
            raise ValueError("sp must be at least 2")
        if model not in ("additive", "multiplicative"):
            raise ValueError("model must be 'additive' or 'multiplicative'")
        self.sp, self.additive = sp, model == "additive"

    def fit(self, tsf):
        sp, half = self.sp, self.sp // 2
        placed = positions(tsf, "__at", "__n")

        def averages(w):
            if sp % 2:
                return {"__cma": F.avg(tsf.target).over(w.rowsBetween(-half, half))}
            left = F.avg(tsf.target).over(w.rowsBetween(-half, half - 1))
            right = F.avg(tsf.target).over(w.rowsBetween(-half + 1, half))
            return {"__cma": (left + right) / 2}

        df = nearby(placed, half, half, averages).df
        inside = (F.col("__at") >= half) & (F.col("__at") < F.col("__n") - half)
        inside = inside & (F.col("__n") >= 2 * sp)
        off = tsf.y - F.col("__cma") if self.additive else tsf.y / F.col("__cma")
        slot = (F.col("__at") % sp).cast("int")
        by_slot = df.groupBy(*tsf.keys, slot.alias("slot")).agg(F.avg(F.when(inside, off)).alias("v"))
        table = by_slot.groupBy(*tsf.keys).agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "v"))).alias("m"),
            F.avg("v").alias("__mean"),
        )
        neutral = 0.0 if self.additive else 1.0

        def index(i):
            v = F.element_at("m", i)
            scaled = v - F.col("__mean") if self.additive else v / F.col("__mean")
            return F.coalesce(scaled, F.lit(neutral))

        season = F.transform(F.sequence(F.lit(0), F.lit(sp - 1)), index)
        return table.select(*tsf.keys, F.struct(season.alias("season")).alias("p"))

    def _index(self, at):
        return F.get(F.col("p.season"), (at % self.sp).cast("int"))

    def forward(self, y, at):
        return y - self._index(at) if self.additive else y / self._index(at)

    def backward(self, y, at):
        return y + self._index(at) if self.additive else y * self._index(at)


# Grid of exponents tried when none is given.
LAMBDAS = tuple(i / 4 for i in range(-4, 9))


def boxcox(y: Column, lam: Column) -> Column:
    return F.when(lam == 0.0, F.log(y)).otherwise((F.pow(y, lam) - 1) / F.nullif(lam, F.lit(0.0)))


def inverse_boxcox(z: Column, lam: Column) -> Column:
    return F.when(lam == 0.0, F.exp(z)).otherwise(
        F.pow(z * lam + 1, 1 / F.nullif(lam, F.lit(0.0)))
    )


class BoxCox(Transformer):
    """Power transform of positive values; the exponent given, or the likeliest of a grid.

    All exponents are scored in one aggregate pass.
    """

    def __init__(self, lam: float | None = None, grid: tuple[float, ...] = LAMBDAS):
        self.grid = (float(lam),) if lam is not None else tuple(grid)

    def fit(self, tsf):
        n, logs = F.count(tsf.y), F.sum(F.log(tsf.y))
        scored = [
            F.struct(
                ((lam - 1) * logs - n / 2 * F.log(F.var_pop(boxcox(tsf.y, F.lit(lam))))).alias("llf"),
                F.lit(lam).alias("lam"),
            )
            for lam in self.grid
        ]
        best = tsf.df.groupBy(*tsf.keys).agg(F.array_max(F.array(*scored)).alias("best"))
        return best.select(*tsf.keys, F.struct(F.col("best.lam").alias("lam")).alias("p"))

    def forward(self, y, at):
        return boxcox(y, F.col("p.lam"))

    def backward(self, y, at):
        return inverse_boxcox(y, F.col("p.lam"))


class Log(Transformer):
    def fit(self, tsf):
        return tsf.df.select(*tsf.keys).distinct().withColumn("p", F.struct(F.lit(0.0).alias("lam")))

    def forward(self, y, at):
        return F.log(y)

    def backward(self, y, at):
        return F.exp(y)


@dataclass(frozen=True)
class Chain:
    """Transformers, then a forecaster; forecasts come back through the inverses."""

    transforms: tuple[Transformer, ...]
    forecaster: Forecaster

    def fit(self, tsf: TimeSeriesFrame) -> "FittedChain":
        """Each transformed series is checkpointed, since the next part reads it more than once."""
        tables, current = [], tsf
        for t in self.transforms:
            table = cut_lineage(t.fit(current))
            tables.append(table)
            moved = t.transform(current, table)
            current = moved.with_df(cut_lineage(moved.df))
        return FittedChain(self, tuple(tables), self.forecaster.fit(current))


@dataclass(frozen=True)
class FittedChain:
    chain: Chain
    tables: tuple[DataFrame, ...]
    params: DataFrame

    def forecast(self, horizon: int = DEFAULT_HORIZON) -> DataFrame:
        keys = keys_of(self.params)
        out = self.chain.forecaster.forecast(self.params, horizon)
        out = null_safe_join(out, self.params.select(*keys, "n"), keys)
        for t, table in reversed(list(zip(self.chain.transforms, self.tables))):
            out = null_safe_join(out, table, keys)
            at = F.col("n") - 1 + F.col("h")
            out = out.withColumn("yhat", t.backward(F.col("yhat"), at)).drop("p")
        return out.select(*keys, "ts", "h", "yhat")


def chain(*parts) -> Chain:
    """`chain(Detrend(), Deseasonalise(12), NaiveLast())`."""
    *transforms, forecaster = parts
    if not isinstance(forecaster, Forecaster) or not all(isinstance(t, Transformer) for t in transforms):
        raise ValueError("chain takes transformers followed by one forecaster")
    return Chain(tuple(transforms), forecaster)


def lags_and_rolling(
    tsf: TimeSeriesFrame, lags=(1,), diffs=(1,), windows=(3,)
) -> TimeSeriesFrame:
    """Columns lag_k, diff_k, and mean and std of the last w values before the row."""
    y = tsf.target
    reach = max([*lags, *diffs, *windows], default=1)

    def exprs(w):
        out = {f"lag_{k}": F.lag(y, k).over(w) for k in lags}
        out.update({f"diff_{k}": F.col(y) - F.lag(y, k).over(w) for k in diffs})
        for k in windows:
            frame = w.rowsBetween(-k, -1)
            full = F.count(y).over(frame) == k
            out[f"mean_{k}"] = F.when(full, F.avg(y).over(frame))
            out[f"std_{k}"] = F.when(full, F.stddev_samp(y).over(frame))
        return out

    return nearby(tsf, reach, 0, exprs)


def _intervals(tsf: TimeSeriesFrame, n_intervals: int) -> TimeSeriesFrame:
    placed = positions(tsf, "__pos", "__n")
    part = F.call_function("div", F.col("__pos") * n_intervals, F.col("__n")).cast("int")
    df = placed.df.withColumn("interval", part).drop("__pos", "__n")
    return replace(placed, df=df, keys=(*tsf.keys, "interval"))


def summary_features(
    tsf: TimeSeriesFrame, n_intervals: int | None = None, quantiles=(0.25, 0.5, 0.75)
) -> DataFrame:
    """mean, std, slope, min, max, quantiles and lag-1 autocorrelation per series,
    or per series and equal interval of positions."""
    frame = tsf if n_intervals is None else _intervals(tsf, n_intervals)
    keys = list(frame.keys)
    lag = lagged(positions(frame, "__pos", None), {"__lag": (tsf.target, 1)}).df
    y = tsf.y
    aggs = {
        "mean": F.avg(y), "std": F.stddev_samp(y), "slope": F.regr_slope(y, F.col("__pos")),
        "min": F.min(y), "max": F.max(y), "acf1": F.corr(y, F.col("__lag")),
    }
    out = with_quantiles(frame, lag, aggs, list(quantiles))
    cols = [F.col("q")[i].alias(f"q{p * 100:g}".replace(".", "_")) for i, p in enumerate(quantiles)]
    return out.select(*keys, "mean", "std", "slope", "min", "max", *cols, "acf1")


def seasonality(tsf: TimeSeriesFrame, max_lag: int = 24, min_lag: int = 2) -> DataFrame:
    """`(keys…, sp, acf)`: the lag with the highest autocorrelation."""
    lags = range(min_lag, max_lag + 1)
    df = lagged(tsf, {f"__l{k}": (tsf.target, k) for k in lags}).df
    scored = df.groupBy(*tsf.keys).agg(
        F.array_max(
            F.array(
                *[
                    F.struct(
                        F.round(F.corr(tsf.y, F.col(f"__l{k}")), 9).alias("acf"),
                        F.lit(-k).alias("k"),
                    )
                    for k in lags
                ]
            )
        ).alias("best")
    )
    return scored.select(*tsf.keys, (-F.col("best.k")).alias("sp"), F.col("best.acf").alias("acf"))
