"""Properties that hold for any series."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronoloom.forecast.naive import Drift, NaiveLast, NaiveMean, SeasonalNaive
from chronoloom.forecast.trend import Trend
from chronoloom.frame import with_roles
from chronoloom.operators.clean import format_series
from chronoloom.operators.split import temporal_split
from tests.helpers import collected

quick = settings(
    max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
value = st.one_of(st.none(), st.integers(-1000, 1000))
series = st.dictionaries(st.integers(0, 60), value, min_size=1, max_size=30)
panels = st.dictionaries(st.sampled_from("abc"), series, min_size=1)
limits = st.sampled_from([1_000_000, 4])


def frame(spark, panel, limit):
    rows = [
        (k, datetime(2024, 1, 1) + timedelta(days=d), None if v is None else float(v))
        for k, points in panel.items()
        for d, v in points.items()
    ]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")
    return with_roles(df, ["k"], "ts", "y", freq="D", max_rows=limit)


@quick
@given(panels, limits)
def test_format(spark, panel, limit):
    out, report = format_series(frame(spark, panel, limit))
    got = {}
    for r in out.df.collect():
        got.setdefault(r["k"], {})[(r["ts"] - datetime(2024, 1, 1)).days] = r["y"]
    for k, points in panel.items():
        # No gaps, and no NULL where any value is known.
        assert sorted(got[k]) == list(range(min(points), max(points) + 1))
        known = [d for d in points if points[d] is not None]
        assert all((v is not None) == bool(known) for v in got[k].values())
        for d, v in got[k].items():
            if known:
                source = max([x for x in known if x <= d], default=min(known))
                assert v == points[source]
    again, second = format_series(out.with_df(out.df, cache={}))
    assert collected(again.df) == collected(out.df)
    assert second.agg(F.sum("gaps_filled"), F.sum("duplicates_removed")).first()[:] == (0, 0)


@quick
@given(panels, limits, st.integers(1, 8))
def test_split_is_a_partition(spark, panel, limit, fh):
    tsf = frame(spark, panel, limit)
    parts = temporal_split(tsf, fh=fh)
    sizes = {k: (len(p) - fh, fh) for k, p in panel.items() if len(p) > fh}
    got = {r["k"]: (r["train_size"], r["n_test"]) for r in parts.sizes().collect()}
    assert got == sizes
    assert {r["k"] for r in parts.rejected.collect()} == set(panel) - set(sizes)
    both = parts.train.df.groupBy("k").agg(F.max("ts").alias("a")).join(
        parts.test.df.groupBy("k").agg(F.min("ts").alias("b")), "k"
    )
    assert both.where("a >= b").count() == 0


@quick
@given(st.lists(st.integers(-50, 50), min_size=4, max_size=25), st.integers(1, 3))
def test_update_is_a_refit(spark, values, fh):
    tsf = frame(spark, {"a": dict(enumerate(values))}, 1_000_000)
    parts = temporal_split(tsf, fh=fh)
    for model in (NaiveLast(), SeasonalNaive(3), NaiveMean(), Drift(), Trend()):
        updated = model.update(model.fit(parts.train), parts.test)
        got = [r["yhat"] for r in model.forecast(updated, 4).orderBy("h").collect()]
        want = [r["yhat"] for r in model.forecast(model.fit(tsf), 4).orderBy("h").collect()]
        assert all((g is None) == (w is None) and (g is None or abs(g - w) < 1e-6) for g, w in zip(got, want))
