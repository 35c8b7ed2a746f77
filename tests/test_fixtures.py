"""Small known cases: loading, cleaning, splitting, forecasting, evaluating."""

from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronoloom.forecast.base import check_horizon, load_params, save_params
from chronoloom.forecast.naive import Drift, NaiveLast, NaiveMean, SeasonalNaive
from chronoloom.forecast.smooth import SES, AutoSmooth, Theta
from chronoloom.forecast.trend import AR1, PooledAR, Trend, TrendExog
from chronoloom.frame import detect_time_column, with_roles
from chronoloom.functions.steps import Step
from chronoloom.operators.clean import (
    format_series, infer_frequency, modal_frequency, overlay, regular_grid, sortedness, to_period,
)
from chronoloom.operators.evaluate import cv_predictions, evaluate
from chronoloom.operators.inspect import is_valid, structure, validate
from chronoloom.operators.split import expanding_folds, sliding_folds, temporal_split
from chronoloom.operators.transform import BoxCox, Deseasonalise, Detrend, Log, chain
from chronoloom.sources.readers import load
from tests.helpers import airline, collected, monthly


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols).collect()]


def inline(spark, data, **config):
    return load(spark, {"type": "inline", "data": data, **config}, config.pop("auto_format", False))


# -- loading and roles -----------------------------------------------------------


def test_ramp_loads_without_missing(spark):
    dates = [f"{2020 + i // 12}-{i % 12 + 1:02d}-01" for i in range(60)]
    tsf = load(
        spark,
        {"type": "inline", "data": {"date": dates, "value": list(range(60))}, "target_column": "value", "frequency": "MS"},
    )
    assert tsf.df.count() == 60 and tsf.df.where("value is null").count() == 0
    assert infer_frequency(tsf).first()["freq"] == "MS"
    parts = temporal_split(tsf, test_size=0.2)
    assert (parts.train.df.count(), parts.test.df.count()) == (48, 12)
    assert temporal_split(tsf, fh=[1, 5, 10]).test.df.count() == 10


def test_no_time_column_counts_rows(spark):
    tsf = inline(spark, {"y": [1, 2, 3, 4]})
    assert rows(tsf.df, "index", "y") == [(0, 1.0), (1, 2.0), (2, 3.0), (3, 4.0)]
    assert infer_frequency(tsf).first()["freq"] == "Integer"


def test_time_column_detection(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 2.0)], "id int, ds string, v double")
    assert detect_time_column(df.schema) == "ds"
    tsf = with_roles(df)
    assert (tsf.time, tsf.target, tsf.exog) == ("ds", "id", ("v",))


def test_wrong_columns_name_what_exists(spark):
    data = {"timestamp": ["2024-01-01"], "value": [1]}
    with pytest.raises(ValueError, match="'index' not found; available.*timestamp"):
        inline(spark, data, time_column="index")
    with pytest.raises(ValueError, match="'nope' not found; available.*value"):
        inline(spark, data, time_column="timestamp", target_column="nope")


def test_bad_time_text_fails(spark):
    tsf = inline(spark, {"date": ["2024-01-01", "soon"], "v": [1, 2]})
    with pytest.raises(Exception, match="is not a time: soon"):
        tsf.df.collect()


def test_text_target_loads_but_cannot_be_evaluated(spark):
    tsf = inline(spark, {"date": ["2024-01-01", "2024-02-01", "2024-03-01"], "value": ["1", "2", "3"]})
    assert "not_numeric" in {r["check"] for r in validate(tsf).collect()}
    with pytest.raises(ValueError, match="not numeric"):
        cv_predictions(NaiveLast(), tsf, expanding_folds(cv_folds=1))


def test_short_series_load(spark):
    for n in (1, 2):
        tsf = inline(spark, {"date": ["2024-01-01", "2024-02-01"][:n], "value": [1.0, 2.0][:n]})
        out, report = format_series(tsf)
        assert out.df.count() == n
        assert "no_frequency" not in {r["check"] for r in validate(tsf).collect()}


def test_empty_is_an_error(spark):
    df = spark.createDataFrame([], "k string, ts timestamp_ntz, y double")
    report = validate(with_roles(df, ["k"], "ts", "y"))
    assert [(r["check"], r["severity"]) for r in report.collect()] == [("empty", "error")]
    assert is_valid(report).first()["valid"] is False


def test_exog_shown_with_prefix(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1.0, 5)], "ts timestamp_ntz, target double, temp bigint")
    shown = {r["column"]: r["scitype"] for r in structure(with_roles(df, (), "ts", "target")).collect()}
    assert "X:temp" in shown and set(shown.values()) == {"Series"}


def test_null_keys_are_kept(spark):
    data = [(k, datetime(2024, 1, d), float(d)) for k in (None, "a") for d in (1, 2, 5)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, y double")
    for limit in (1_000_000, 2):
        out, _ = format_series(with_roles(df, ["k"], "ts", "y", freq="D", max_rows=limit))
        assert out.df.groupBy("k").count().where("count = 5").count() == 2


# -- cleaning --------------------------------------------------------------------


def test_duplicates_keep_the_first(spark):
    data = pd.DataFrame(
        {"date": ["2024-01-01", "2024-01-01", "2024-02-01", "2024-03-01"], "value": [1.0, 1.5, 2.0, 3.0], "row": range(4)}
    )
    tsf = inline(spark, data, target_column="value", tie_columns=["row"], exog_columns=[])
    out, report = format_series(tsf)
    assert [r[1] for r in rows(out.df, "date", "value")] == [1.0, 2.0, 3.0]
    assert report.first()["duplicates_removed"] == 1


def test_irregular_has_no_frequency(spark):
    times = [datetime(2020, 1, 1), datetime(2020, 1, 5), datetime(2020, 3, 2)]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "ts timestamp_ntz, v bigint")
    assert infer_frequency(with_roles(df)).first()["freq"] is None


def test_unsorted_is_reported(spark):
    data = [(0, datetime(2024, 3, 1), 3.0), (1, datetime(2024, 1, 1), 1.0), (2, datetime(2024, 2, 1), 2.0)]
    df = spark.createDataFrame(data, "n bigint, ts timestamp_ntz, v double")
    tsf = with_roles(df, (), "ts", "v", ["n"])
    assert sortedness(tsf, "n").first()["was_unsorted"] is True


def times_of(tsf):
    return [r[0] for r in rows(tsf.df, "ts")]


@pytest.mark.parametrize(
    "freq,times,missing",
    [
        ("W", ["2024-01-01", "2024-01-08", "2024-01-22", "2024-01-29"], "2024-01-15"),
        ("MS", ["2024-01-15", "2024-02-15", "2024-04-15", "2024-05-15"], "2024-03-15"),
        ("ME", ["2024-01-31", "2024-02-29", "2024-04-30", "2024-05-31"], "2024-03-31"),
        ("15min", ["2024-01-01 00:00", "2024-01-01 00:15", "2024-01-01 00:45", "2024-01-01 01:00"], "2024-01-01 00:30"),
    ],
)
def test_hole_is_filled_on_the_series_own_grid(spark, freq, times, missing):
    data = [(t, float(i)) for i, t in enumerate(times)]
    df = spark.createDataFrame(data, "ts string, y double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    declared = regular_grid(with_roles(df, freq=freq))
    want = sorted(pd.Timestamp(t).to_pydatetime() for t in [*times, missing])
    assert times_of(declared) == want
    if freq != "ME":
        assert times_of(format_series(with_roles(df))[0]) == want


def test_format_twice_changes_nothing(spark):
    tsf = monthly(spark, [1, None, 3, 4, 5, None])
    holes = tsf.with_df(tsf.df.where("month(ts) <> 4"))
    once, _ = format_series(holes)
    twice, report = format_series(once)
    assert collected(once.df) == collected(twice.df)
    assert report.first()["gaps_filled"] == 0


def test_all_null_series_stays_null(spark):
    out, _ = format_series(monthly(spark, [None, None, None]))
    assert out.df.where("y is null").count() == 3


def test_two_keys_with_their_own_frequency(spark):
    a = monthly(spark, [1, 2, 3, 4], key="m")
    days = [("d", datetime(2024, 1, d), float(d)) for d in (1, 2, 4, 5)]
    df = a.df.unionByName(spark.createDataFrame(days, a.df.schema))
    out, report = format_series(with_roles(df, ["k"], "ts", "y"))
    assert dict(rows(report, "k", "frequency")) == {"m": "MS", "d": "D"}
    assert dict(rows(out.df.groupBy("k").count(), "k", "count")) == {"m": 4, "d": 5}


def test_messy_sales(spark):
    months = [f"{2023 + i // 12}-{i % 12 + 1:02d}-01" for i in range(18)]
    data = [(m, 100.0 + i, float(i), "north") for i, m in enumerate(months) if i != 7]
    data[3] = (months[3], None, 3.0, "north")
    data.append((months[0], 999.0, 0.0, "north"))
    df = spark.createDataFrame(data, "date string, revenue double, promo_spend double, region string")
    df = df.coalesce(1).withColumn("row", F.monotonically_increasing_id())
    tsf = with_roles(df, (), "date", "revenue", ["promo_spend", "region"], ties=["row"])
    out, report = format_series(tsf)
    assert out.df.count() == 18 and out.df.where("revenue is null or region is null").count() == 0
    got = report.first()
    assert (got["duplicates_removed"], got["gaps_filled"], got["missing_filled"]) == (1, 1, 2)
    assert temporal_split(out, fh=6).test.df.count() == 6


def test_calendar_anchor(spark):
    data = [(datetime(2024, m, 1), 1.0) for m in (2, 3, 5)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, y double")
    out = regular_grid(with_roles(df, freq="QS"), anchor="calendar")
    assert times_of(out) == []
    df = spark.createDataFrame([(datetime(2024, m, 1), 1.0) for m in (1, 10)], "ts timestamp_ntz, y double")
    assert len(times_of(regular_grid(with_roles(df, freq="QS"), anchor="calendar"))) == 4


def test_periods(spark):
    df = spark.createDataFrame([(datetime(2024, 5, 17, 13, 44),)], "ts timestamp_ntz").withColumn("y", F.lit(1.0))
    for freq, want in {
        "MS": datetime(2024, 5, 1), "QS": datetime(2024, 4, 1), "YS": datetime(2024, 1, 1),
        "W": datetime(2024, 5, 13), "D": datetime(2024, 5, 17), "h": datetime(2024, 5, 17, 13),
        "15min": datetime(2024, 5, 17, 13, 30),
    }.items():
        assert times_of(to_period(with_roles(df), freq)) == [want]


def test_bad_frequency(spark):
    for bad in ("", "nope", "0D", "3x"):
        with pytest.raises(ValueError):
            Step.parse(bad)


def test_overlay_labels(spark):
    a, b = monthly(spark, [1, 2]), monthly(spark, [3])
    labels = {r["label"] for r in overlay([a, b], ["one"]).collect()}
    assert labels == {"one", "Series 2"}
    ints = with_roles(spark.createDataFrame([("a", 1, 2.0)], "k string, t bigint, y double"), ["k"], "t", "y")
    assert overlay([a, ints], ["x", "y", "too many"]).schema["ts"].dataType.simpleString() == "string"


# -- splits ----------------------------------------------------------------------


def test_split_arguments(spark):
    tsf = monthly(spark, range(5))
    for bad in (
        {}, {"test_size": 0.2, "fh": 1}, {"test_size": 1.0}, {"test_size": 0.0}, {"fh": 0}, {"fh": []}, {"fh": [1, -2]},
    ):
        with pytest.raises(ValueError):
            temporal_split(tsf, **bad)
    assert temporal_split(tsf, fh=5).rejected.count() == 1
    with pytest.raises(Exception, match="more rows than a series has"):
        temporal_split(tsf, fh=5, strict=True).train.df.collect()


def test_fold_counts(spark):
    tsf = airline(spark)
    assert expanding_folds(initial_window=140).counts(tsf).first()["n_folds"] == 4
    table = sliding_folds(24, step=12).table(tsf)
    assert table.where("train_end - train_start <> 24").count() == 0 and table.count() == 10
    assert expanding_folds(cv_folds=144).counts(tsf).first()["n_folds"] == 0


# -- forecasting -----------------------------------------------------------------


def test_airline_golden(spark):
    tsf, model = airline(spark), SeasonalNaive(12)
    params = model.fit(tsf)
    ahead = rows(model.forecast(params, 12), "h", "yhat")
    assert [v for _, v in ahead] == [417, 391, 419, 461, 472, 535, 622, 606, 508, 461, 390, 432]
    assert params.first()["n"] == 144
    assert rows(model.forecast(params, 1), "ts") == [(datetime(1961, 1, 1),)]
    scores, summary = evaluate(model, tsf, expanding_folds(cv_folds=3))
    s = summary.first()
    assert round(s["mean"], 4) == 0.0838 and s["min"] <= s["mean"] <= s["max"] and scores.count() == 3
    refit = evaluate(AutoSmooth(12), tsf, expanding_folds(cv_folds=3))[1].first()
    assert refit["mean"] < 0.06


@pytest.mark.parametrize(
    "model",
    [NaiveLast(), SeasonalNaive(12), NaiveMean(), NaiveMean(sp=12), NaiveMean(window_length=5), Drift(), Trend(),
     Trend(2), SES(), Theta(), AutoSmooth(12), AR1(), PooledAR(2)],
    ids=lambda m: f"{type(m).__name__}",
)
def test_cv_gives_no_null(spark, model):
    values = [100 + i + 10 * (i % 12) for i in range(48)]
    scores, _ = evaluate(model, monthly(spark, values, start=(2000, 1)), expanding_folds(cv_folds=3), ["mape", "rmse"])
    got = scores.collect()
    assert len(got) == 3 and all(r["mape"] is not None and r["mape"] >= 0 for r in got)


@pytest.mark.parametrize(
    "kind,args",
    [(NaiveLast, ()), (SeasonalNaive, (12,)), (NaiveMean, ()), (NaiveMean, (1, 6)), (Drift, ()), (Trend, ())],
    ids=lambda v: getattr(v, "__name__", str(v)),
)
def test_running_folds_equal_refitting(spark, kind, args):
    refitted = type("Refitted", (kind,), {"rolling": lambda self, *_: None})
    tsf = airline(spark)
    for folds in (expanding_folds(cv_folds=5, fh=(1, 3)), sliding_folds(24, step=30, fh=(2,))):
        fast = cv_predictions(kind(*args), tsf, folds)
        assert collected(fast) == collected(cv_predictions(refitted(*args), tsf, folds))


def test_missing_score_fails(spark):
    with pytest.raises(Exception, match="No forecast or actual value"):
        evaluate(SeasonalNaive(12), monthly(spark, range(6)), expanding_folds(cv_folds=2))[0].collect()


def test_update(spark):
    tsf = monthly(spark, [100 + i for i in range(24)])
    new = monthly(spark, [200, 210, 220], start=(2022, 1))
    model = NaiveLast()
    old = model.fit(tsf)
    late = model.update(old, new)
    assert model.forecast(late, 1).first()["yhat"] == 220
    assert late.first()["n"] == 27 and model.forecast(old, 1).first()["yhat"] == 123
    with pytest.raises(ValueError, match="new rows"):
        model.update(old, new.with_df(new.df.limit(0)))
    with pytest.raises(NotImplementedError):
        Trend(2).update(Trend(2).fit(tsf), new)


@pytest.mark.parametrize("model", [NaiveLast(), SeasonalNaive(12), NaiveMean(), Drift(), Trend()], ids=lambda m: type(m).__name__)
def test_update_equals_refit(spark, model):
    tsf = airline(spark)
    for fh in (3, 20):
        parts = temporal_split(tsf, fh=fh)
        updated = model.update(model.fit(parts.train), parts.test)
        assert collected(model.forecast(updated, 13)) == collected(model.forecast(model.fit(tsf), 13))


def test_update_with_a_new_series(spark):
    model = NaiveMean()
    params = model.update(model.fit(monthly(spark, [1, 3])), monthly(spark, [5, 7], key="b"))
    assert dict(rows(model.forecast(params, 1), "k", "yhat")) == {"a": 2.0, "b": 6.0}


def test_params_round_trip(spark, tmp_path):
    model, path = Trend(), str(tmp_path / "params")
    params = model.fit(airline(spark))
    save_params(params, path)
    assert collected(load_params(spark, path)) == collected(params)
    with pytest.raises(Exception, match="already exists"):
        save_params(params, path)
    save_params(params, path, overwrite=True)
    with pytest.raises(ValueError, match="fit a forecaster first"):
        model.forecast(spark.range(1), 3)


def test_arguments(spark):
    for bad in (0, -1, 1.5, "3", True, None):
        with pytest.raises(ValueError):
            check_horizon(bad)
    params = NaiveLast().fit(airline(spark))
    with pytest.raises(ValueError, match="residuals"):
        NaiveLast().intervals(params)
    with pytest.raises(ValueError):
        NaiveLast().intervals(NaiveLast().fit(airline(spark), residuals=True), coverage=1.5)
    with pytest.raises(ValueError):
        evaluate(NaiveLast(), airline(spark), metrics=["nope"])
    with pytest.raises(ValueError, match="frequency"):
        NaiveLast().fit(airline(spark).with_df(airline(spark).df, freq=None))
    with pytest.raises(ValueError, match="future|X"):
        TrendExog(["x"]).forecast(params, 3)


def test_intervals_grow_and_nest(spark):
    for model in (NaiveLast(), SeasonalNaive(12), Drift(), Trend(), SES(), Theta(), AutoSmooth(12), AR1()):
        params = model.fit(airline(spark), residuals=True)
        got = model.intervals(params, 14, [0.5, 0.9]).orderBy("h").collect()
        width = [r["upper_90"] - r["lower_90"] for r in got]
        assert all(a <= b + 1e-9 for a, b in zip(width, width[1:])), type(model)
        assert all(r["lower_90"] < r["lower_50"] < r["upper_50"] < r["upper_90"] for r in got)


def test_transform_inverses(spark):
    tsf = airline(spark)
    for t in (Detrend(), Deseasonalise(12), Deseasonalise(12, "multiplicative"), BoxCox(), BoxCox(0.5), Log()):
        p = t.fit(tsf)
        assert collected(t.inverse(t.transform(tsf, p), p).df, 6) == collected(tsf.df, 6)


def test_chain_beats_its_forecaster(spark):
    parts = temporal_split(airline(spark), fh=12)
    seasonal = chain(Log(), Detrend(), Deseasonalise(12), NaiveLast()).fit(parts.train)
    actual = parts.test.df.withColumnRenamed("y", "actual")
    err = seasonal.forecast(12).join(actual, ["k", "ts"]).agg(F.avg(F.abs(F.col("yhat") / F.col("actual") - 1))).first()[0]
    assert err < 0.1
    with pytest.raises(ValueError):
        chain(Log(), Detrend())
