"""A model that is updated equals one that is fitted on all rows, spread included."""

import pytest
from pyspark.sql import functions as F

from chronoloom.forecast.base import load_params, save_params
from chronoloom.forecast.naive import NaiveLast
from chronoloom.forecast.smooth import SES, Theta
from chronoloom.forecast.trend import AR1, Trend
from chronoloom.operators.split import temporal_split
from tests.helpers import collected, daily_panel, monthly

MODELS = [SES(), SES(0.3), Theta(), AR1(), Trend()]
NAMES = ["ses", "ses_fixed", "theta", "ar1", "trend"]


def fitted(model, tsf):
    return model.fit(tsf, residuals=not isinstance(model, Theta))


def same(model, got, want):
    sides = []
    for p in (got, want):
        p = p.withColumn("sse", F.round("sse", 4))
        sides.append((collected(model.forecast(p, 5)), collected(model.distribution(p, 5)), collected(p.select("k", "cutoff", "n", "dof"))))
    assert sides[0] == sides[1]


@pytest.mark.parametrize("model, max_rows", [(m, r) for m in MODELS for r in (1_000_000, 40)])
def test_update_equals_fit(spark, model, max_rows):
    tsf = daily_panel(spark, max_rows, holes=False, nulls=False)
    tsf = tsf.with_df(tsf.df.where("k <> 'one'"))
    parts = temporal_split(tsf, fh=9)
    same(model, model.update(fitted(model, parts.train), parts.test), fitted(model, tsf))


@pytest.mark.parametrize("model", MODELS, ids=NAMES)
def test_sides_alone_and_short(spark, model):
    """Series of one side only stay; a single old or new value is enough."""
    old = monthly(spark, [3.0, 5.0, 4.0, 8.0], key="a").df.union(monthly(spark, [7.0], key="b").df)
    new = monthly(spark, [6.0], start=(2030, 1), key="b").df.union(monthly(spark, [1.0, 4.0, 2.0, 9.0], start=(2030, 1), key="c").df)
    frame = monthly(spark, [0.0])
    params = model.update(fitted(model, frame.with_df(old)), frame.with_df(new))
    whole = {r.k: r for r in fitted(model, frame.with_df(old.union(new))).collect()}
    got = {r.k: r for r in params.collect()}
    assert sorted(got) == ["a", "b", "c"] and {k: r.n for k, r in got.items()} == {"a": 4, "b": 2, "c": 4}
    for k in got:
        assert got[k].cutoff == whole[k].cutoff
        for c in ("level", "alpha", "slope", "intercept", "phi", "a", "last", "sse"):
            if c in params.columns:
                assert got[k][c] == pytest.approx(whole[k][c]), (k, c)


@pytest.mark.parametrize("model", [*MODELS, NaiveLast()], ids=[*NAMES, "last"])
def test_early_rows_are_refused(spark, model):
    tsf = monthly(spark, [3.0, 5.0, 4.0, 8.0])
    params = model.fit(tsf)
    with pytest.raises(ValueError, match="later rows"):
        model.update(params, monthly(spark, [1.0, 2.0], start=(2020, 1)))
    with pytest.raises(ValueError, match="new rows"):
        model.update(params, tsf.with_df(tsf.df.limit(0)))


@pytest.mark.parametrize("model", [SES(), AR1()], ids=["ses", "ar1"])
def test_saved_state_goes_on(spark, model, tmp_path):
    """Three updates in a row, each from a saved table."""
    tsf = daily_panel(spark, 1_000_000, holes=False, nulls=False)
    tsf = tsf.with_df(tsf.df.where("k <> 'one'"))
    rest, pieces = tsf, []
    for _ in range(3):
        parts = temporal_split(rest, fh=3)
        rest, pieces = parts.train, [parts.test, *pieces]
    params = fitted(model, rest)
    for i, piece in enumerate(pieces):
        save_params(model.update(params, piece), str(tmp_path / str(i)))
        params = load_params(spark, str(tmp_path / str(i)))
    same(model, params, fitted(model, tsf))
