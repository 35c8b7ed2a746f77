"""Series far from zero, rows without a time, grids longer than a task, folds that never mix."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronoloom.forecast.naive import NaiveLast
from chronoloom.forecast.smooth import ALPHAS, SES
from chronoloom.forecast.trend import PooledAR
from chronoloom.frame import with_roles
from chronoloom.operators.clean import format_series, regular_grid
from chronoloom.operators.detect import change_points
from chronoloom.operators.evaluate import cv_predictions, evaluate
from chronoloom.operators.split import expanding_folds, sliding_folds
from chronoloom.operators.transform import Deseasonalise, Detrend, Log, chain
from chronoloom.sources.readers import load
from chronoloom.sources.writers import save
from tests.helpers import monthly


def test_smoothing_far_from_zero(spark):
    rng = random.Random(4)
    values = [1e9 + rng.gauss(0, 1) for _ in range(120)]

    def direct(alpha):
        level, sse = values[0], 0.0
        for y in values:
            sse += (y - level) ** 2
            level += alpha * (y - level)
        return sse, alpha, level

    sse, alpha, level = min(direct(a) for a in ALPHAS)
    for max_rows in (1_000, 30):
        got = SES().fit(monthly(spark, values, start=(1950, 1), max_rows=max_rows)).first()
        assert got.alpha == alpha
        assert abs(got.sse - sse) < 1e-3 and abs(got.level - level) < 1e-4


def test_rows_without_a_time_are_counted(spark):
    rows = [("a", datetime(2024, 1, d), float(d)) for d in (1, 2, 2, 4)] + [("a", None, 9.0), ("a", None, 9.0)]
    tsf = with_roles(spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double"), ["k"], "ts", "y", freq="D", ties=["y"])
    out, report = format_series(tsf)
    got = report.first()
    assert (got.rows_in, got.null_time_rows, got.duplicates_removed, got.off_grid_rows) == (6, 2, 1, 0)
    assert (got.rows_out, got.gaps_filled) == (4, 1) and out.df.count() == 4


def test_grids_are_measured_anew(spark):
    rows = [("a", datetime(2024, 1, 1), 1.0), ("a", datetime(2024, 3, 1), 2.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")
    tsf = with_roles(df, ["k"], "ts", "y", max_rows=1_000)
    assert tsf.width == 0
    grid = regular_grid(tsf, "h")
    assert grid.df.count() == 1_441 and grid.width > 0
    assert regular_grid(tsf, "D").width == 0
    filled = format_series(with_roles(df, ["k"], "ts", "y", freq="h", max_rows=1_000))[0]
    assert filled.df.agg(F.count("y"), F.sum("y")).first()[:] == (1_441, 1_442.0)


def test_pooled_folds_do_not_learn_from_each_other(spark):
    rng = random.Random(6)
    values = [50 + rng.gauss(0, 5) for _ in range(24)] + [500 + 40 * i for i in range(6)]
    tsf = monthly(spark, values)
    folds = expanding_folds(fh=1, cv_folds=2)
    first = cv_predictions(PooledAR(2), tsf, folds).orderBy("ts").first()
    before = tsf.with_df(tsf.df.where(F.col("ts") < F.lit(first.ts)))
    alone = PooledAR(2)
    want = alone.forecast(alone.fit(before), 1).first()
    assert abs(first.yhat - want.yhat) < 1e-6


def test_scaled_errors_by_fold(spark):
    values = [3.0, 5, 4, 8, 6, 9, 7, 12, 10, 11]
    tsf = monthly(spark, values)
    for folds in (expanding_folds(fh=2, cv_folds=3), sliding_folds(5, step=2, fh=2)):
        scores, summary = evaluate(NaiveLast(), tsf, folds, ["mase", "mae"], sp=2)
        assert summary.count() == 2
        starts = {r.fold: r for r in folds.table(tsf).collect()}
        seen = scores.collect()
        assert len(seen) == len(starts) > 1
        first = folds.initial or len(values) - 2 - (folds.cv_folds - 1) * folds.step
        for r in seen:
            end = first + r.fold * folds.step
            train = values[end - folds.window if folds.window else 0 : end]
            scale = sum(abs(b - a) for a, b in zip(train, train[2:])) / (len(train) - 2)
            mae = sum(abs(y - train[-1]) for y in (values[end + h - 1] for h in folds.fh)) / len(folds.fh)
            assert abs(r.mae - mae) < 1e-9 and abs(r.mase - mae / scale) < 1e-9
    with pytest.raises(ValueError):
        evaluate(NaiveLast(), tsf, sliding_folds(5), ["mase"], sp=5)
    with pytest.raises(Exception, match="No seasonal difference"):
        evaluate(NaiveLast(), tsf, expanding_folds(cv_folds=2), ["mase"], sp=9)[0].collect()


def test_json_with_a_column_called_time(spark, tmp_path):
    tsf, path = monthly(spark, [1, None, 3]), f"{tmp_path}/a.json"
    save(tsf, path, "json", time_name="time")
    config = {"type": "file", "path": path, "key_columns": ["k"], "time_column": "time", "target_column": "y"}
    got = load(spark, config, False).df
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, tsf.df.collect()), key=str)
    with pytest.raises(ValueError, match="already"):
        save(tsf, f"{path}.2", "json", time_name="y")


def _scans(df):
    """Leaves of the plan; what was checkpointed is one."""
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return text.count("LogicalRDD") + text.count("Relation [")


def test_plans_grow_with_rounds_and_parts(spark):
    tsf = monthly(spark, [float(20 + i % 12 + 9 * (i > 30)) for i in range(60)])
    rounds = [_scans(change_points(tsf, n)) for n in (2, 3, 4)]
    assert rounds[2] - rounds[1] == rounds[1] - rounds[0] <= 2
    one = chain(Detrend(), NaiveLast()).fit(tsf)
    three = chain(Log(), Detrend(), Deseasonalise(12), NaiveLast()).fit(tsf)
    assert _scans(three.forecast(2)) - _scans(one.forecast(2)) <= 2
