"""Forecast errors as aggregate expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import lagged

# Smallest double step at 1, the usual guard against division by zero.
EPS = 2.220446049250313e-16


def _abs_error(y: Column, yhat: Column) -> Column:
    return F.abs(y - yhat)


def mae(y: Column, yhat: Column) -> Column:
    return F.avg(_abs_error(y, yhat))


def mse(y: Column, yhat: Column) -> Column:
    return F.avg((y - yhat) * (y - yhat))


def rmse(y: Column, yhat: Column) -> Column:
    return F.sqrt(mse(y, yhat))


def mape(y: Column, yhat: Column) -> Column:
    """Plain form: the error relative to the actual value, as a fraction."""
    return F.avg(_abs_error(y, yhat) / F.greatest(F.abs(y), F.lit(EPS)))


def smape(y: Column, yhat: Column) -> Column:
    """Symmetric form: twice the error over the sum of absolute values."""
    return F.avg(2 * _abs_error(y, yhat) / F.greatest(F.abs(y) + F.abs(yhat), F.lit(EPS)))


def gmae(y: Column, yhat: Column) -> Column:
    """Geometric mean of absolute errors; exact hits count as EPS."""
    return F.exp(F.avg(F.log(F.greatest(_abs_error(y, yhat), F.lit(EPS)))))


POINT: dict[str, Callable[[Column, Column], Column]] = {
    "mae": mae, "mse": mse, "rmse": rmse, "mape": mape, "smape": smape, "gmae": gmae,
}


#: Metrics that also need the training rows.
SCALED = ("mase",)
#: Metrics of a normal forecast, with mean and deviation.
NORMAL = ("coverage", "pinball", "crps")


def resolve(name: str) -> Callable[[Column, Column], Column]:
    if name in SCALED:
        raise ValueError(f"Metric {name!r} needs the training rows; use evaluate")
    if name in NORMAL:
        raise ValueError(f"Metric {name!r} needs a mean and a deviation; use evaluate or `normal`")
    if name not in POINT:
        raise ValueError(f"Unknown metric {name!r}; use one of {[*POINT, *SCALED, *NORMAL]}")
    return POINT[name]


def score(
    df: DataFrame, metrics: Iterable[str] = ("mape",), by: Iterable[str] = (), y="y", yhat="yhat"
) -> DataFrame:
    """One row per group with a column for each metric."""
    return df.groupBy(*by).agg(
        *[resolve(m)(F.col(y), F.col(yhat)).alias(m) for m in metrics]
    )


def scale_table(tsf: TimeSeriesFrame, sp: int = 1) -> DataFrame:
    """`(keys…, scale)`: mean absolute seasonal difference of the training rows."""
    rows = lagged(tsf, {"__lag": (tsf.target, sp)}).df
    return rows.groupBy(*tsf.keys).agg(F.avg(F.abs(tsf.y - F.col("__lag"))).alias("scale"))


def mase(scored: DataFrame, scales: DataFrame, by: Iterable[str], y="y", yhat="yhat") -> DataFrame:
    """Mean absolute error over the training scale of the series."""
    by = list(by)
    errors = scored.groupBy(*by).agg(mae(F.col(y), F.col(yhat)).alias("mae"))
    out = errors.join(scales, by)
    return out.select(*by, (F.col("mae") / F.greatest("scale", F.lit(EPS))).alias("mase"))


def coverage(y: Column, lower: Column, upper: Column) -> Column:
    """Share of actual values inside the interval."""
    return F.avg(y.between(lower, upper).cast("double"))


def pinball(y: Column, q: Column, alpha: Column) -> Column:
    return F.avg(F.greatest(alpha * (y - q), (alpha - 1) * (y - q)))


def crps_normal(y: Column, mu: Column, sigma: Column, levels: int = 99) -> Column:
    """CRPS of a normal forecast as twice the mean pinball loss over an even quantile grid."""
    alphas = [(i + 1) / (levels + 1) for i in range(levels)]
    total = None
    grid = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(NormalDist().inv_cdf(a)).alias("z")) for a in alphas])
    losses = F.transform(
        grid,
        lambda g: F.greatest(
            g["a"] * (y - mu - sigma * g["z"]), (g["a"] - 1) * (y - mu - sigma * g["z"])
        ),
    )
    total = F.aggregate(losses, F.lit(0.0), lambda acc, x: acc + x)
    return F.avg(2 * total / levels)


def normal(name: str, y: Column, mu: Column, sigma: Column, level: float = 0.9, alpha=(0.05, 0.95)) -> Column:
    """A metric of NORMAL: the share of values in the central interval of `level`, the pinball loss
    averaged over the quantiles `alpha`, or the CRPS."""
    if name == "crps":
        return crps_normal(y, mu, sigma)
    if name == "coverage":
        z = NormalDist().inv_cdf(0.5 + level / 2)
        return coverage(y, mu - z * sigma, mu + z * sigma)
    if name != "pinball":
        raise ValueError(f"Unknown metric {name!r}; use one of {[*NORMAL]}")
    losses = [pinball(y, mu + NormalDist().inv_cdf(a) * sigma, F.lit(float(a))) for a in alpha]
    return sum(losses[1:], losses[0]) / len(losses)
