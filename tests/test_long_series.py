"""Series cut into chunks must give what a plain window gives."""

import pytest
from pyspark.sql import functions as F

from chronoloom.forecast.naive import Drift, NaiveLast, NaiveMean, SeasonalNaive
from chronoloom.forecast.smooth import SES, AutoSmooth, Theta
from chronoloom.forecast.trend import AR1, Trend, TrendExog
from chronoloom.functions.ordered import filled, lagged, nearby, positions, running, whole
from chronoloom.operators import clean, inspect
from chronoloom.operators.detect import change_points, hampel
from chronoloom.operators.evaluate import cv_predictions
from chronoloom.operators.split import cutoff_rows, expanding_folds, history_at, sliding_folds, temporal_split
from chronoloom.operators.transform import BoxCox, Deseasonalise, Detrend, lags_and_rolling, seasonality, summary_features
from tests.helpers import collected, daily_panel

PLAIN, CUT = 1_000_000, 7


@pytest.fixture(scope="module")
def both(spark):
    plain, cut = daily_panel(spark, PLAIN), daily_panel(spark, CUT)
    assert plain.width == 0 and cut.width > 0
    return plain, cut


@pytest.fixture(scope="module")
def full(spark):
    plain, cut = (daily_panel(spark, n, holes=False, nulls=False) for n in (PLAIN, CUT))
    assert plain.width == 0 and cut.width > 0
    return plain, cut


def same(pair, fn):
    a, b = (collected(fn(t)) for t in pair)
    assert a[1], "nothing to compare"
    assert a == b


def test_positions(both):
    same(both, lambda t: positions(t).df)


def test_running(both):
    aggs = {k: (k, F.col("y")) for k in ("sum", "count", "min", "max")}
    same(both, lambda t: running(t, aggs).df)


@pytest.mark.parametrize("forward,backward", [(True, True), (True, False), (False, True)])
def test_filled(both, forward, backward):
    same(both, lambda t: filled(t, ["y"], forward, backward).df)


def test_lagged(both):
    same(both, lambda t: lagged(t, {"a": ("y", 1), "b": ("y", 20), "c": ("y", -3)}).df)


def test_nearby(both):
    same(both, lambda t: nearby(t, 4, 6, lambda w: {"m": F.avg("y").over(w.rowsBetween(-4, 6))}).df)


def test_whole(both):
    same(both, lambda t: whole(t, {"lo": F.min("ts"), "m": F.avg("y")}).df)


def test_frequency(both):
    same(both, clean.infer_frequency)
    same(both, clean.modal_frequency)


def test_grid_and_format(both):
    same(both, lambda t: clean.regular_grid(t).df)
    same(both, lambda t: clean.format_series(t)[0].df)
    same(both, lambda t: clean.format_series(t)[1])


def test_inspection(both):
    for fn in (inspect.describe, inspect.validate, inspect.head, inspect.extent):
        same(both, fn)


def test_splits(both):
    same(both, lambda t: temporal_split(t, test_size=0.3).marked)
    same(both, lambda t: temporal_split(t, fh=20).rejected)


def test_folds(both):
    same(both, expanding_folds(cv_folds=4).expand)
    same(both, sliding_folds(6, 3, fh=(1, 2)).expand)
    cuts = both[0].df.where("day(ts) in (5, 20)").select("k", F.col("ts").alias("cutoff"))
    same(both, lambda t: cutoff_rows(t, cuts, fh=(1, 3)))
    same(both, lambda t: history_at(t, cuts))


@pytest.mark.parametrize(
    "model",
    [NaiveLast(), SeasonalNaive(7), NaiveMean(), Drift(), Trend(), SES(), AR1(), AutoSmooth(7)],
    ids=lambda m: type(m).__name__,
)
def test_forecasters(full, model):
    same(full, lambda t: model.distribution(model.fit(t, residuals=True), 9))


@pytest.mark.parametrize(
    "model", [NaiveMean(sp=7), NaiveMean(window_length=10), Trend(2), Theta()], ids=["smean", "wmean", "trend2", "theta"]
)
def test_point_forecasters(full, model):
    same(full, lambda t: model.forecast(model.fit(t), 9))


def test_trend_exog(full):
    model = TrendExog(["x"])

    def run(t):
        parts = temporal_split(t, fh=5)
        return model.forecast(model.fit(parts.train), 5, X=parts.test)

    same(full, run)


@pytest.mark.parametrize("model", [SeasonalNaive(7), NaiveMean(), Drift(), Trend(), SES()], ids=lambda m: type(m).__name__)
def test_evaluate(full, model):
    def run(t):
        long_only = t.with_df(t.df.where("k <> 'one'"))
        return cv_predictions(model, long_only, expanding_folds(cv_folds=4, fh=(1, 2)))

    same(full, run)


def test_transforms(full):
    for t in (Detrend(), Deseasonalise(7), BoxCox()):
        same(full, lambda f, t=t: t.transform(f, t.fit(f)).df)
    same(full, lambda f: lags_and_rolling(f, (1, 9), (2,), (3, 12)).df)
    same(full, lambda f: seasonality(f, 9))
    same(full, lambda f: summary_features(f))
    same(full, lambda f: summary_features(f, n_intervals=3))


def test_detection(full):
    same(full, lambda t: hampel(t, 3, 2.0))
    same(full, lambda t: change_points(t, 3, min_size=2))
