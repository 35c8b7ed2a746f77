"""One pass over all folds against a fit for each, with and without chunks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.forecast import running as R
from chronoloom.forecast.naive import Drift, NaiveLast, NaiveMean, SeasonalNaive
from chronoloom.forecast.smooth import SES, Theta
from chronoloom.forecast.trend import AR1, Trend
from chronoloom.functions import metrics as M
from chronoloom.operators.evaluate import cv_predictions, evaluate
from chronoloom.operators.split import expanding_folds
from tests.helpers import collected, daily_panel

MODELS = [NaiveLast(), SeasonalNaive(3), NaiveMean(), Drift(), SES(), SES(0.3), Theta(), AR1()]


def refitted(model):
    other = type(model).__new__(type(model))
    other.__dict__.update(model.__dict__)
    other.rolling = other.rolling_normal = lambda *a: None
    return other


@pytest.mark.parametrize(
    "model, max_rows", [(m, 1_000_000) for m in MODELS] + [(m, 40) for m in (Drift(), SES(), Theta(), AR1())],
    ids=lambda m: str(m) if isinstance(m, int) else type(m).__name__,
)
def test_all_folds_equal_refits(spark, model, max_rows):
    tsf = daily_panel(spark, max_rows, holes=False, nulls=False)
    folds = expanding_folds(cv_folds=4, step=3, fh=(1, 4))
    tsf = tsf.with_df(tsf.df.where("k <> 'one'"))
    got = cv_predictions(model, tsf, folds, spread=True)
    whole = tsf.with_df(tsf.df, span=None, cache={}, max_rows=1_000_000)
    assert collected(got) == collected(cv_predictions(refitted(model), whole, folds, spread=True))


@pytest.mark.parametrize("model", [SES(), Theta(), AR1()], ids=lambda m: type(m).__name__)
def test_values_that_are_missing(spark, model):
    """Rows before a cutoff may be NULL; those that are scored may not."""
    tsf = daily_panel(spark, 1_000_000, holes=False, nulls=False)
    # The last rows of each series stay, as only they are scored.
    early = F.dayofyear("ts") % 4 == 1
    gone = early & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    tsf = tsf.with_df(tsf.df.where("k <> 'one'").withColumn("y", F.when(~gone, F.col("y"))))
    folds = expanding_folds(cv_folds=3)
    assert collected(cv_predictions(model, tsf, folds, spread=True)) == collected(
        cv_predictions(refitted(model), tsf, folds, spread=True)
    )


def test_walk_equals_a_loop():
    rng = np.random.default_rng(2)
    y = rng.normal(size=137) * 50
    y[[3, 60, 61]] = np.nan
    alphas = np.array([0.1, 0.5, 1.0])
    level, sse = np.zeros(3), np.zeros(3)
    levels, errors = R.walk_levels(y, alphas, level, sse)
    for v, a, e in zip(y, levels, errors):
        if not np.isnan(v):
            sse = sse + (v - level) ** 2
            level = level + alphas * (v - level)
        assert np.allclose(a, level) and np.allclose(e, sse)
    a, b, s0, s1, s2 = R.compose(R.level_maps(y, alphas))
    assert np.allclose(a * 7 + b, R.walk_levels(y, alphas, np.full(3, 7.0), np.zeros(3))[0][-1])
    assert np.allclose(s0 - 14 * s1 + 49 * s2, R.walk_levels(y, alphas, np.full(3, 7.0), np.zeros(3))[1][-1])


def test_far_from_zero(spark):
    tsf = daily_panel(spark, 1_000_000, holes=False, nulls=False)
    far = tsf.with_df(tsf.df.withColumn("y", F.col("y") + 1e9))
    folds = expanding_folds(initial_window=9, step=7)
    for model in (SES(), AR1(), NaiveMean()):
        near, moved = (
            {(r.k, r.fold): (r.yhat, r.sigma) for r in cv_predictions(model, t, folds, spread=True).collect()}
            for t in (tsf, far)
        )
        assert all(np.allclose(near[k], (moved[k][0] - 1e9, moved[k][1]), rtol=1e-4) for k in near)


def test_scores_of_normal_forecasts(spark):
    tsf = daily_panel(spark, 1_000_000, holes=False, nulls=False)
    folds = expanding_folds(initial_window=12, step=6, fh=(1, 2))
    names = ["mae", "coverage", "pinball", "crps", "mase"]
    scores, summary = evaluate(Trend(), tsf, folds, names, level=0.8, alpha=(0.1, 0.5, 0.9))
    rows = cv_predictions(Trend(), tsf, folds, spread=True).where("k = 'mid' and fold = 1").toPandas()
    got = scores.where("k = 'mid' and fold = 1").first()
    z = {a: M.NormalDist().inv_cdf(a) for a in (0.1, 0.5, 0.9)}
    y, mu, s = (rows[c].to_numpy() for c in ("y", "yhat", "sigma"))
    assert got.coverage == np.mean(np.abs(y - mu) <= z[0.9] * s)
    loss = np.mean([np.mean(np.maximum(a * (y - mu - v * s), (a - 1) * (y - mu - v * s))) for a, v in z.items()])
    assert abs(got.pinball - loss) < 1e-9 and 0 < got.crps < got.mae + s.max()
    assert summary.select("metric").distinct().count() == 5
    with pytest.raises(ValueError):
        evaluate(Trend(), tsf, folds, ["crps"], level=1.5)
    with pytest.raises(ValueError):
        M.resolve("crps")
