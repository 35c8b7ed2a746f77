"""Cross-validated evaluation of a forecaster over all series and folds in one job."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.forecast.base import Forecaster, levels
from chronoloom.forecast.naive import NaiveMean
from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions import metrics as M
from chronoloom.functions.ordered import lagged, null_safe_join
from chronoloom.operators.split import Folds


def cv_predictions(
    forecaster: Forecaster, tsf: TimeSeriesFrame, folds: Folds, spread: bool = False
) -> DataFrame:
    """`(keys…, fold, h, ts, y, yhat)` for every test row of every fold.

    A model with a running form gives the forecasts of all folds in one pass over the
    series. Others are fitted per (key, fold) on the rows that each fold uses. With `spread`,
    `sigma` is the standard deviation of the forecast, from the errors within the fold.
    """
    if not isinstance(tsf.df.schema[tsf.target].dataType, T.NumericType):
        raise ValueError(f"Target column '{tsf.target}' is not numeric; convert it first")
    if not isinstance(forecaster, Forecaster):
        raise ValueError("evaluate needs a forecaster")
    out = (forecaster.rolling_normal if spread else forecaster.rolling)(tsf, folds.fh, folds.window)
    if out is not None:
        scored = _rolling_predictions(tsf, out.df, folds, spread=spread)
    else:
        scored = _refit_predictions(forecaster, tsf, folds, spread)
    keys = list(tsf.keys)
    gone = F.col("yhat").isNull() | F.isnan("yhat") | F.col("y").isNull()
    if spread:
        gone = gone | F.col("sigma").isNull() | F.isnan("sigma")
    where = F.to_json(F.struct(*keys, "fold", "h"))
    checked = F.when(gone, F.raise_error(F.concat(F.lit("No forecast or actual value at "), where)))
    return scored.select(
        *keys, "fold", "h", "ts", "y", checked.otherwise(F.col("yhat")).cast("double").alias("yhat"),
        *(["sigma"] if spread else []),
    )


def _rolling_predictions(
    tsf: TimeSeriesFrame, df: DataFrame, folds: Folds, fh: tuple[int, ...] | None = None, spread: bool = False
) -> DataFrame:
    made = ["yhat", "sigma"] if spread else ["yhat"]
    steps = F.array(
        *[F.struct(F.lit(h).alias("h"), *[F.col(f"{c}_{h}").alias(c) for c in made]) for h in fh or folds.fh]
    )
    rows = df.select(
        *tsf.keys, tsf.ts.alias("ts"), tsf.y.alias("y"), "pos", "n", F.explode(steps).alias("s")
    )
    n, end = F.col("n"), F.col("pos") - F.col("s.h") + 1
    first = folds.first_end(n)
    fold = F.call_function("div", end - first, F.lit(folds.step))
    used = (end >= first) & (first + fold * folds.step == end) & (fold < folds.count(n))
    return rows.where(used).select(
        *tsf.keys, fold.alias("fold"), F.col("s.h").alias("h"), "ts", "y", *[F.col(f"s.{c}").alias(c) for c in made]
    )


def _refit_predictions(
    forecaster: Forecaster, tsf: TimeSeriesFrame, folds: Folds, spread: bool = False
) -> DataFrame:
    rows = folds.expand(tsf)
    keys = [*tsf.keys, "fold"]
    train = replace(tsf, df=rows.where("role = 'train'"), keys=tuple(keys), span=None)
    if hasattr(forecaster, "within"):  # pooled over series, but never over folds
        forecaster = forecaster.within("fold")
    params = forecaster.fit(train, residuals=True) if spread else forecaster.fit(train)
    more = {}
    if tsf.exog and hasattr(forecaster, "exog"):
        more["X"] = replace(train, df=rows.where("role = 'test'"))
    if spread:
        ahead = forecaster.distribution(params, max(folds.fh), **more).select(*keys, "h", F.col("mu").alias("yhat"), "sigma")
    else:
        ahead = forecaster.forecast(params, max(folds.fh), **more).select(*keys, "h", "yhat")
    test = rows.where("role = 'test'").select(
        *keys, "h", tsf.ts.alias("ts"), tsf.y.alias("y")
    )
    return null_safe_join(test, ahead, [*keys, "h"], "left")


def evaluate(
    forecaster: Forecaster,
    tsf: TimeSeriesFrame,
    folds: Folds | None = None,
    metrics: Iterable[str] = ("mape",),
    sp: int = 1,
    level: float = 0.9,
    alpha: tuple[float, ...] = (0.05, 0.95),
) -> tuple[DataFrame, DataFrame]:
    """(scores per key and fold, summary per key and metric). A missing score fails the job.

    The metrics `coverage` (of the central interval of `level`), `pinball` (averaged over the
    quantiles `alpha`) and `crps` score the normal forecast of each fold.

    The metric `mase` is scaled by the seasonal differences, `sp` rows apart, of the rows that
    the fold trains on; the job fails if a fold has none.
    """
    metrics = list(metrics)
    for m in metrics:
        if m not in M.SCALED and m not in M.NORMAL:
            M.resolve(m)
    levels(level, "level")
    alpha = levels(alpha, "alpha")
    folds = folds or Folds(cv_folds=3)
    spread = any(m in M.NORMAL for m in metrics)
    preds = cv_predictions(forecaster, tsf, folds, spread)
    by = [*tsf.keys, "fold"]
    y, yhat = F.col("y"), F.col("yhat")
    plain = [
        (M.normal(m, y, yhat, F.col("sigma"), level, alpha) if m in M.NORMAL else M.resolve(m)(y, yhat)).alias(m)
        for m in metrics
        if m not in M.SCALED
    ]
    if len(plain) == len(metrics):
        scores = preds.groupBy(*by).agg(*plain)
    else:
        errors = preds.groupBy(*by).agg(*plain, M.mae(y, yhat).alias("__mae"))
        scores = null_safe_join(errors, training_scales(tsf, folds, sp), by, "left")
        none = F.raise_error(F.concat(F.lit("No seasonal difference to scale by at "), F.to_json(F.struct(*by))))
        scale = F.coalesce("scale", none.cast("double"))
        scores = scores.withColumn("mase", F.col("__mae") / F.greatest(scale, F.lit(M.EPS))).select(*by, *metrics)
    return scores, cv_summary(scores, tsf.keys, metrics)


def training_scales(tsf: TimeSeriesFrame, folds: Folds, sp: int = 1) -> DataFrame:
    """`(keys…, fold, scale)`: mean absolute seasonal difference of the rows each fold trains on.

    All folds come from one running mean of the differences; a window of w rows holds the last
    w - sp of them.
    """
    if sp < 1 or (folds.window and folds.window <= sp):
        raise ValueError("sp must be positive and less than the window")
    gaps = lagged(tsf, {"__lag": (tsf.target, sp)})
    gaps = gaps.with_df(gaps.df.withColumn(tsf.target, F.abs(tsf.y - F.col("__lag"))).drop("__lag"))
    fh = folds.fh[:1]
    means = NaiveMean().rolling(gaps, fh, folds.window and folds.window - sp)
    return _rolling_predictions(gaps, means.df, folds, fh).select(*tsf.keys, "fold", F.col("yhat").alias("scale"))


def cv_summary(scores: DataFrame, keys: Iterable[str], metrics: Iterable[str]) -> DataFrame:
    """`(keys…, metric, mean, std, min, max)`; std is NULL for one fold."""
    long = scores.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in metrics])
        ).alias("s"),
    )
    return long.groupBy(*keys, F.col("s.metric").alias("metric")).agg(
        F.avg("s.v").alias("mean"),
        F.stddev_samp("s.v").alias("std"),
        F.min("s.v").alias("min"),
        F.max("s.v").alias("max"),
    )
