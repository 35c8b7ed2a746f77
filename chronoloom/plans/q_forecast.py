"""Forecasters, intervals, updates, metrics and evaluation."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from chronoloom.forecast.base import join_actuals, load_params, save_params
from chronoloom.forecast.custom import custom_forecaster
from chronoloom.forecast.naive import Drift, NaiveLast, NaiveMean, SeasonalNaive
from chronoloom.forecast.smooth import ALPHAS, SES, AutoSmooth, Theta
from chronoloom.forecast.trend import AR1, PooledAR, Trend, TrendExog
from chronoloom.functions import metrics as M
from chronoloom.operators.clean import fill_missing, regular_grid
from chronoloom.operators.evaluate import cv_predictions, evaluate
from chronoloom.operators.split import expanding_folds, sliding_folds, temporal_split
from chronoloom.operators.transform import Deseasonalise, Detrend, chain
from chronoloom.plans.panels import (
    PRIORITY_POS, STATUS_POS, TYPE_POS, by_priority, by_status,
    by_type,
)
from chronoloom.plans.registry import ORACLE, query, rounded
from chronoloom.shared import shared_dir

H = 12
# Forecast rows of every priority: `e` is the end of the series, `f` adds steps 1..12.
_FUTURE = f"""{PRIORITY_POS},
  e AS (SELECT priority, max(ts) AS cutoff, count(*) AS n FROM by_priority GROUP BY 1),
  f AS (SELECT priority, cutoff, n, CAST(h AS INTEGER) AS h, cutoff + to_months(CAST(h AS INTEGER)) AS ts
        FROM e, (SELECT unnest(generate_series(1, {H})) AS h))"""


def _z(p: float) -> float:
    return NormalDist().inv_cdf(p)


# -- point forecasts ------------------------------------------------------------


@query(
    f"""WITH {_FUTURE} SELECT f.priority, f.ts, f.h, p.y AS yhat
        FROM f JOIN p ON p.priority = f.priority AND p.pos = f.n - 1"""
)
def naive_last(spark, sf_dir):
    model = NaiveLast()
    return model.forecast(model.fit(by_priority(spark, sf_dir)), H)


@query(
    f"""WITH {_FUTURE} SELECT f.priority, f.ts, f.h, p.y AS yhat
        FROM f JOIN p ON p.priority = f.priority AND p.pos = f.n - 12 + (f.h - 1) % 12"""
)
def naive_seasonal(spark, sf_dir):
    model = SeasonalNaive(12)
    return model.forecast(model.fit(by_priority(spark, sf_dir)), H)


@query(
    f"""WITH {_FUTURE}, m AS (SELECT priority, avg(y) AS yhat FROM p GROUP BY 1)
        SELECT priority, ts, h, round(yhat, 6) AS yhat FROM f JOIN m USING (priority)"""
)
def naive_mean(spark, sf_dir):
    model = NaiveMean()
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat")


@query(
    f"""WITH {_FUTURE}, m AS (SELECT priority, avg(y) AS yhat FROM p WHERE pos >= n - 24 GROUP BY 1)
        SELECT priority, ts, h, round(yhat, 6) AS yhat FROM f JOIN m USING (priority)"""
)
def naive_window_mean(spark, sf_dir):
    model = NaiveMean(window_length=24)
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat")


@query(
    f"""WITH {_FUTURE}, m AS (
          SELECT priority, CAST((12 - (n - pos) % 12) % 12 AS INTEGER) AS slot, avg(y) AS yhat FROM p GROUP BY 1, 2)
        SELECT f.priority, ts, h, round(yhat, 6) AS yhat
        FROM f JOIN m ON m.priority = f.priority AND m.slot = (f.h - 1) % 12"""
)
def naive_seasonal_mean(spark, sf_dir):
    model = NaiveMean(sp=12)
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat")


@query(
    f"""WITH {_FUTURE}, m AS (SELECT priority, max_by(y, pos) AS last,
          (max_by(y, pos) - min_by(y, pos)) / (count(*) - 1) AS slope FROM p GROUP BY 1)
        SELECT priority, ts, h, round(last + h * slope, 6) AS yhat FROM f JOIN m USING (priority)"""
)
def drift(spark, sf_dir):
    model = Drift()
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat")


@query(
    f"""WITH {_FUTURE}, m AS (
          SELECT priority, regr_slope(y, pos) AS b, regr_intercept(y, pos) AS a FROM p GROUP BY 1)
        SELECT priority, ts, h, round(a + b * (n - 1 + h), 6) AS yhat FROM f JOIN m USING (priority)"""
)
def trend_linear(spark, sf_dir):
    model = Trend()
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat")


@query(
    f"""WITH {_FUTURE}, c AS (SELECT priority, pos, y, n, pos - (n - 1) / 2 AS u FROM p),
        s AS (SELECT priority, count(*) AS n, sum(y) AS y0, sum(y * u) AS y1, sum(y * u * u) AS y2,
                     sum(u * u) AS s2, sum(u * u * u * u) AS s4 FROM c GROUP BY 1),
        k AS (SELECT priority, y1 / s2 AS b1, (n * y2 - s2 * y0) / (n * s4 - s2 * s2) AS b2,
                     (s4 * y0 - s2 * y2) / (n * s4 - s2 * s2) AS b0 FROM s)
        SELECT priority, ts, h, round(b0 + b1 * (n - 1 + h - (n - 1) / 2)
               + b2 * (n - 1 + h - (n - 1) / 2) * (n - 1 + h - (n - 1) / 2), 4) AS yhat
        FROM f JOIN k USING (priority)"""
)
def trend_quadratic(spark, sf_dir):
    model = Trend(degree=2)
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat", digits=4)


@query(
    f"""WITH {STATUS_POS}, t AS (SELECT * FROM p WHERE n > 12 AND pos < n - 12),
        v AS (SELECT * FROM p WHERE n > 12 AND pos >= n - 12),
        m AS (SELECT flag, status, count(*) AS n, avg(y) AS my, avg(pos) AS mp, avg(x) AS mx,
                var_pop(pos) AS pp, var_pop(x) AS xx, covar_pop(pos, x) AS px,
                covar_pop(y, pos) AS py, covar_pop(y, x) AS xy FROM t GROUP BY 1, 2),
        k AS (SELECT *, (py * xx - xy * px) / (pp * xx - px * px) AS b,
                        (xy * pp - py * px) / (pp * xx - px * px) AS c FROM m)
        SELECT v.flag, v.status, v.ts, CAST(v.pos - k.n + 1 AS INTEGER) AS h,
               round(my + b * (v.pos - mp) + c * (v.x - mx), 4) AS yhat
        FROM v JOIN k ON v.flag = k.flag AND v.status = k.status"""
)
def trend_exogenous(spark, sf_dir):
    parts = temporal_split(by_status(spark, sf_dir), fh=H)
    model = TrendExog(["x"])
    return rounded(model.forecast(model.fit(parts.train), H, X=parts.test), "yhat", digits=4)


def _ses_sql(panel: str, key: str) -> str:
    """Recursive smoothing for every alpha of the grid, and the best one per series."""
    return f"""g AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS alpha),
  r AS (
    SELECT {key}, pos, n, CAST(alpha AS DOUBLE) AS alpha, y AS level, CAST(0 AS DOUBLE) AS sse
    FROM {panel}, g WHERE pos = 0
    UNION ALL
    SELECT r.{key}, q.pos, q.n, alpha, alpha * q.y + (1 - alpha) * level, sse + (q.y - level) * (q.y - level)
    FROM r JOIN {panel} q ON q.{key} = r.{key} AND q.pos = r.pos + 1),
  best AS (SELECT * FROM r WHERE pos = n - 1
           QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY sse, alpha) = 1)"""


@query(
    f"""WITH RECURSIVE {_FUTURE}, {_ses_sql('p', 'priority')}
        SELECT f.priority, f.ts, f.h, round(level, 6) AS yhat FROM f JOIN best b ON b.priority = f.priority"""
)
def smoothing_simple(spark, sf_dir):
    model = SES()
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat")


@query(
    f"""WITH RECURSIVE {_FUTURE}, {_ses_sql('p', 'priority')},
        s AS (SELECT priority, regr_slope(y, pos) AS slope FROM p GROUP BY 1)
        SELECT f.priority, f.ts, f.h,
               round(level + 0.5 * slope * (f.h - 1 + (1 - pow(1 - alpha, f.n)) / alpha), 6) AS yhat
        FROM f JOIN best b ON b.priority = f.priority JOIN s ON s.priority = f.priority"""
)
def theta(spark, sf_dir):
    model = Theta()
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat")


_AR = """l AS (SELECT *, lag(y) OVER (PARTITION BY priority ORDER BY pos) AS prev FROM p),
  m AS (SELECT priority, regr_slope(y, prev) AS phi, regr_intercept(y, prev) AS a, max_by(y, pos) AS last
        FROM l GROUP BY 1)"""


@query(
    f"""WITH {_FUTURE}, {_AR}
        SELECT priority, ts, h, round(a * (1 - pow(phi, h)) / (1 - phi) + pow(phi, h) * last, 6) AS yhat
        FROM f JOIN m USING (priority)"""
)
def autoregression(spark, sf_dir):
    model = AR1()
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat")


@query()
def autoregression_pooled(spark, sf_dir):
    model = PooledAR(12)
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat", digits=3)


@query()
def smoothing_auto(spark, sf_dir):
    model = AutoSmooth(12)
    return rounded(model.forecast(model.fit(by_priority(spark, sf_dir)), H), "yhat", digits=3)


@query(
    f"""WITH {TYPE_POS} SELECT event_type, median(y) AS level, count(*) AS n
        FROM p WHERE pos >= n - 7 GROUP BY 1"""
)
def custom_model(spark, sf_dir):
    """A user's own model: the median of the last week."""

    def last_week(pdf):
        tail = pdf.tail(7)
        out = tail.iloc[:1][["event_type"]].copy()
        out["level"], out["n"] = tail["y"].median(), len(tail)
        return out

    run = custom_forecaster(last_week, "event_type string, level double, n bigint")
    return run(by_type(spark, sf_dir))


# -- uncertainty ----------------------------------------------------------------

_SIGMA_LAST = """s AS (SELECT priority, max_by(y, pos) AS mu,
    sqrt(sum((y - prev) * (y - prev)) / (count(*) - 1)) AS sigma
  FROM (SELECT *, lag(y) OVER (PARTITION BY priority ORDER BY pos) AS prev FROM p) GROUP BY 1)"""
_SIGMA_SEASON = """s AS (SELECT priority, sqrt(sum((y - prev) * (y - prev)) / (count(*) - 12)) AS sigma
  FROM (SELECT *, lag(y, 12) OVER (PARTITION BY priority ORDER BY pos) AS prev FROM p) GROUP BY 1),
  q AS (SELECT f.priority, f.ts, f.h, p.y AS mu, sigma * sqrt((f.h - 1) // 12 + 1) AS sd
        FROM f JOIN p ON p.priority = f.priority AND p.pos = f.n - 12 + (f.h - 1) % 12
        JOIN s ON s.priority = f.priority)"""


@query(
    f"""WITH {_FUTURE}, {_SIGMA_LAST}
        SELECT priority, ts, h,
               round(mu - {_z(0.95)} * sigma * sqrt(h), 6) AS lower_90, round(mu + {_z(0.95)} * sigma * sqrt(h), 6) AS upper_90,
               round(mu - {_z(0.975)} * sigma * sqrt(h), 6) AS lower_95, round(mu + {_z(0.975)} * sigma * sqrt(h), 6) AS upper_95
        FROM f JOIN s USING (priority)"""
)
def interval_last(spark, sf_dir):
    model = NaiveLast()
    params = model.fit(by_priority(spark, sf_dir), residuals=True)
    out = model.intervals(params, H, coverage=[0.9, 0.95])
    return rounded(out, "lower_90", "upper_90", "lower_95", "upper_95")


@query(
    f"""WITH {_FUTURE}, {_SIGMA_SEASON}
        SELECT priority, ts, h, round(mu + {_z(0.05)} * sd, 6) AS q_5, round(mu + {_z(0.5)} * sd, 6) AS q_50,
               round(mu + {_z(0.95)} * sd, 6) AS q_95 FROM q"""
)
def quantiles_seasonal(spark, sf_dir):
    model = SeasonalNaive(12)
    params = model.fit(by_priority(spark, sf_dir), residuals=True)
    return rounded(model.quantiles(params, H, alpha=[0.05, 0.5, 0.95]), "q_5", "q_50", "q_95")


@query(
    f"""WITH {_FUTURE}, m AS (SELECT priority, avg(pos) AS mx, regr_sxx(y, pos) AS sxx,
          (regr_syy(y, pos) - regr_sxy(y, pos) * regr_sxy(y, pos) / regr_sxx(y, pos)) / (count(*) - 2) AS s2
          FROM p GROUP BY 1)
        SELECT priority, ts, h, round(s2 * (1 + 1 / n + (n - 1 + h - mx) * (n - 1 + h - mx) / sxx), 2) AS variance
        FROM f JOIN m USING (priority)"""
)
def variance_trend(spark, sf_dir):
    model = Trend()
    params = model.fit(by_priority(spark, sf_dir), residuals=True)
    return rounded(model.variance(params, H), "variance", digits=2)


@query(
    f"""WITH {_FUTURE}, d AS (SELECT *, y - lag(y) OVER (PARTITION BY priority ORDER BY pos) AS d FROM p),
        m AS (SELECT priority, max_by(y, pos) AS last, (max_by(y, pos) - min_by(y, pos)) / (count(*) - 1) AS slope,
                sqrt((sum(d * d) - sum(d) * sum(d) / count(d)) / (count(*) - 2)) AS sigma FROM d GROUP BY 1)
        SELECT priority, ts, h, round(last + h * slope, 6) AS mu, round(sigma * sqrt(h * (1 + h / (n - 1))), 5) AS sigma
        FROM f JOIN m USING (priority)"""
)
def distribution_drift(spark, sf_dir):
    model = Drift()
    params = model.fit(by_priority(spark, sf_dir), residuals=True)
    return rounded(rounded(model.distribution(params, H), "mu"), "sigma", digits=5)


@query(
    f"""WITH {PRIORITY_POS} SELECT priority, max(ts) AS cutoff, count(*) AS n,
        round(regr_slope(y, pos), 6) AS slope, round(regr_intercept(y, pos), 6) AS intercept FROM p GROUP BY 1"""
)
def fitted_parameters(spark, sf_dir):
    params = Trend().fit(by_priority(spark, sf_dir))
    return rounded(params.select("priority", "cutoff", "n", "slope", "intercept"), "slope", "intercept")


@query(
    f"""WITH {_FUTURE} SELECT f.priority, f.ts, f.h, p.y AS yhat
        FROM f JOIN p ON p.priority = f.priority AND p.pos = f.n - 12 + (f.h - 1) % 12"""
)
def params_saved_and_loaded(spark, sf_dir):
    model, path = SeasonalNaive(12), shared_dir(spark, "params")
    save_params(model.fit(by_priority(spark, sf_dir)), path)
    return model.forecast(load_params(spark, path), H)


@query(
    f"""WITH {_FUTURE}, m AS (
          SELECT priority, regr_slope(y, pos) AS b, regr_intercept(y, pos) AS a FROM p GROUP BY 1)
        SELECT priority, ts, h, round(a + b * (n - 1 + h), 6) AS yhat FROM f JOIN m USING (priority)"""
)
def update_trend(spark, sf_dir):
    """Fitted without the last year, then updated with it: as if fitted on everything."""
    parts, model = temporal_split(by_priority(spark, sf_dir), fh=12), Trend()
    params = model.update(model.fit(parts.train), parts.test)
    return rounded(model.forecast(params, H), "yhat")


@query(
    f"""WITH {_FUTURE} SELECT f.priority, f.ts, f.h, p.y AS yhat
        FROM f JOIN p ON p.priority = f.priority AND p.pos = f.n - 12 + (f.h - 1) % 12"""
)
def update_seasonal(spark, sf_dir):
    parts, model = temporal_split(by_priority(spark, sf_dir), fh=5), SeasonalNaive(12)
    return model.forecast(model.update(model.fit(parts.train), parts.test), H)


def _updated(model, tsf, residuals=False):
    """Fitted without the last year, then updated with it; the SQL fits on everything."""
    parts = temporal_split(tsf, fh=12)
    return model.update(model.fit(parts.train, residuals=residuals), parts.test)


@query(ORACLE["smoothing_simple"])
def update_smoothing(spark, sf_dir):
    model = SES()
    return rounded(model.forecast(_updated(model, by_priority(spark, sf_dir)), H), "yhat")


@query(ORACLE["theta"])
def update_theta(spark, sf_dir):
    model = Theta()
    return rounded(model.forecast(_updated(model, by_priority(spark, sf_dir)), H), "yhat")


@query(ORACLE["autoregression"])
def update_autoregression(spark, sf_dir):
    model = AR1()
    return rounded(model.forecast(_updated(model, by_priority(spark, sf_dir)), H), "yhat")


@query(ORACLE["variance_trend"])
def interval_after_update(spark, sf_dir):
    model = Trend()
    params = _updated(model, by_priority(spark, sf_dir), residuals=True)
    return rounded(model.variance(params, H), "variance", digits=2)


# -- composition ----------------------------------------------------------------


@query(
    f"""WITH {_FUTURE}, m AS (SELECT priority, regr_slope(y, pos) AS b, regr_intercept(y, pos) AS a FROM p GROUP BY 1),
        d AS (SELECT priority, pos, n, y - (a + b * pos) AS r FROM p JOIN m USING (priority))
        SELECT f.priority, f.ts, f.h, round(d.r + a + b * (f.n - 1 + f.h), 6) AS yhat
        FROM f JOIN m ON m.priority = f.priority
        JOIN d ON d.priority = f.priority AND d.pos = f.n - 12 + (f.h - 1) % 12"""
)
def detrend_then_seasonal(spark, sf_dir):
    fitted = chain(Detrend(), SeasonalNaive(12)).fit(by_priority(spark, sf_dir))
    return rounded(fitted.forecast(H), "yhat")


SEASON_SQL = """c AS (SELECT *, (avg(y) OVER (w ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
      + avg(y) OVER (w ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 AS cma
    FROM p WINDOW w AS (PARTITION BY priority ORDER BY pos)),
  v AS (SELECT priority, pos % 12 AS slot, avg(y - cma) AS v FROM c WHERE pos >= 6 AND pos < n - 6 GROUP BY 1, 2),
  s AS (SELECT priority, slot, v - avg(v) OVER (PARTITION BY priority) AS s FROM v)"""


@query(
    f"""WITH {_FUTURE}, {SEASON_SQL},
        a AS (SELECT p.priority, max_by(p.y - s.s, p.pos) AS last FROM p
              JOIN s ON s.priority = p.priority AND s.slot = p.pos % 12 GROUP BY 1)
        SELECT f.priority, f.ts, f.h, round(a.last + s.s, 6) AS yhat
        FROM f JOIN a ON a.priority = f.priority
        JOIN s ON s.priority = f.priority AND s.slot = (f.n - 1 + f.h) % 12"""
)
def deseasonalise_then_last(spark, sf_dir):
    fitted = chain(Deseasonalise(12), NaiveLast()).fit(by_priority(spark, sf_dir))
    return rounded(fitted.forecast(H), "yhat")


# -- evaluation -----------------------------------------------------------------

# One-step seasonal forecasts (week) over the last 14 days of each type.
_CV = f"""{TYPE_POS}, cv AS (
  SELECT * FROM (SELECT event_type, pos - (n - 14) AS fold, ts, y,
    lag(y, 7) OVER (PARTITION BY event_type ORDER BY pos) AS yhat, pos, n FROM p) WHERE pos >= n - 14)"""
_EPS = "2.220446049250313e-16"


def _cv(spark, sf_dir):
    return cv_predictions(SeasonalNaive(7), by_type(spark, sf_dir), expanding_folds(cv_folds=14))


@query(
    f"""WITH {TYPE_POS} SELECT event_type,
        round(avg(abs(y - yhat) / greatest(abs(y), {_EPS})), 9) AS mape, round(avg(abs(y - yhat)), 6) AS mae
        FROM (SELECT *, lag(y, 7) OVER (PARTITION BY event_type ORDER BY pos) AS yhat FROM p)
        WHERE pos >= n - 7 GROUP BY 1"""
)
def backtest_seasonal(spark, sf_dir):
    """Grid, fill, hold out the last week, seasonal naive, join with actuals, score."""
    tsf = fill_missing(regular_grid(by_type(spark, sf_dir)))
    parts, model = temporal_split(tsf, fh=7), SeasonalNaive(7)
    found = join_actuals(model.forecast(model.fit(parts.train), 7), parts.test)
    out = M.score(found, ["mape", "mae"], by=["event_type"])
    return rounded(rounded(out, "mape", digits=9), "mae")


@query(f"WITH {_CV} SELECT event_type, fold, CAST(1 AS INTEGER) AS h, ts, y, yhat FROM cv")
def forecast_with_actual(spark, sf_dir):
    return _cv(spark, sf_dir)


@query(
    f"""WITH {_CV} SELECT event_type, round(avg(abs(y - yhat)), 6) AS mae, round(avg((y - yhat) * (y - yhat)), 2) AS mse,
        round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
        round(avg(abs(y - yhat) / greatest(abs(y), {_EPS})), 9) AS mape,
        round(avg(2 * abs(y - yhat) / greatest(abs(y) + abs(yhat), {_EPS})), 9) AS smape,
        round(exp(avg(ln(greatest(abs(y - yhat), {_EPS})))), 4) AS gmae
        FROM cv GROUP BY 1"""
)
def point_metrics(spark, sf_dir):
    out = M.score(_cv(spark, sf_dir), list(M.POINT), by=["event_type"])
    out = rounded(rounded(out, "mae", "rmse"), "mse", digits=2)
    return rounded(rounded(out, "mape", "smape", digits=9), "gmae", digits=4)


@query(
    f"""WITH {_CV}, sc AS (SELECT event_type, avg(abs(y - prev)) AS scale
          FROM (SELECT *, lag(y, 7) OVER (PARTITION BY event_type ORDER BY pos) AS prev FROM p)
          WHERE pos < n - 14 GROUP BY 1)
        SELECT event_type, round(avg(abs(y - yhat)) / greatest(any_value(scale), {_EPS}), 9) AS mase
        FROM cv JOIN sc USING (event_type) GROUP BY 1"""
)
def metric_mase(spark, sf_dir):
    train = temporal_split(by_type(spark, sf_dir), fh=14).train
    out = M.mase(_cv(spark, sf_dir), M.scale_table(train, sp=7), ["event_type"])
    return rounded(out, "mase", digits=9)


# Normal forecasts of the held-out last year, from the last value before it.
_HELD = f"""{PRIORITY_POS}, tr AS (SELECT * FROM p WHERE pos < n - 12),
  te AS (SELECT *, pos - (n - 12) + 1 AS h FROM p WHERE pos >= n - 12),
  s AS (SELECT priority, max_by(y, pos) AS mu, sqrt(sum((y - prev) * (y - prev)) / (count(*) - 1)) AS sigma
        FROM (SELECT *, lag(y) OVER (PARTITION BY priority ORDER BY pos) AS prev FROM tr) GROUP BY 1),
  held AS (SELECT priority, y, mu, sigma * sqrt(h) AS sd FROM te JOIN s USING (priority))"""


def _held(spark, sf_dir):
    parts, model = temporal_split(by_priority(spark, sf_dir), fh=12), NaiveLast()
    dist = model.distribution(model.fit(parts.train, residuals=True), 12)
    return join_actuals(dist, parts.test)


@query(
    f"""WITH {_HELD} SELECT priority,
        round(avg(CASE WHEN y BETWEEN mu - {_z(0.95)} * sd AND mu + {_z(0.95)} * sd THEN 1 ELSE 0 END), 9) AS coverage_90,
        round(avg(greatest(0.1 * (y - mu - {_z(0.1)} * sd), (0.1 - 1) * (y - mu - {_z(0.1)} * sd))), 6) AS pinball_10
        FROM held GROUP BY 1"""
)
def metric_interval(spark, sf_dir):
    y, mu, sd = F.col("y"), F.col("mu"), F.col("sigma")
    out = _held(spark, sf_dir).groupBy("priority").agg(
        M.coverage(y, mu - _z(0.95) * sd, mu + _z(0.95) * sd).alias("coverage_90"),
        M.pinball(y, mu + _z(0.1) * sd, F.lit(0.1)).alias("pinball_10"),
    )
    return rounded(rounded(out, "coverage_90", digits=9), "pinball_10")


_LEVELS = ", ".join(f"({(i + 1) / 100}, {_z((i + 1) / 100)})" for i in range(99))


@query(
    f"""WITH {_HELD}, q(a, z) AS (VALUES {_LEVELS})
        SELECT priority, round(2 * sum(greatest(a * (y - mu - sd * z), (a - 1) * (y - mu - sd * z))) / count(*), 6) AS crps
        FROM held, q GROUP BY 1"""
)
def metric_crps(spark, sf_dir):
    out = _held(spark, sf_dir).groupBy("priority").agg(
        M.crps_normal(F.col("y"), F.col("mu"), F.col("sigma")).alias("crps")
    )
    return rounded(out, "crps")


@query(
    f"""WITH {_CV} SELECT event_type, fold, round(avg(abs(y - yhat) / greatest(abs(y), {_EPS})), 9) AS mape
        FROM cv GROUP BY 1, 2"""
)
def evaluate_folds(spark, sf_dir):
    scores, _ = evaluate(SeasonalNaive(7), by_type(spark, sf_dir), expanding_folds(cv_folds=14))
    return rounded(scores, "mape", digits=9)


@query(
    f"""WITH {_CV}, d AS (
          SELECT *, abs(y - lag(y, 7) OVER (PARTITION BY event_type ORDER BY pos)) AS gap FROM p),
        f AS (SELECT event_type, fold, avg(abs(y - yhat)) AS mae, min(ts) AS first FROM cv GROUP BY 1, 2),
        s AS (SELECT f.event_type, f.fold, avg(d.gap) AS scale
              FROM f JOIN d ON d.event_type = f.event_type AND d.ts < f.first GROUP BY 1, 2)
        SELECT event_type, fold, round(mae, 6) AS mae, round(mae / greatest(scale, {_EPS}), 9) AS mase
        FROM f JOIN s USING (event_type, fold)"""
)
def evaluate_mase(spark, sf_dir):
    folds = expanding_folds(cv_folds=14)
    scores, _ = evaluate(SeasonalNaive(7), by_type(spark, sf_dir), folds, ["mae", "mase"], sp=7)
    return rounded(rounded(scores, "mae"), "mase", digits=9)



@query(
    f"""WITH {TYPE_POS}, r AS (SELECT *, (first_value(y) OVER w) AS y0, lag(y) OVER w AS last,
            avg(y) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mean
          FROM p WINDOW w AS (PARTITION BY event_type ORDER BY pos)),
        e AS (SELECT event_type, abs(y - mean) AS mae_mean, abs(y - (last + (last - y0) / (pos - 1))) AS mae_drift
              FROM r WHERE pos >= 10)
        SELECT event_type, 'mean' AS model, round(avg(mae_mean), 6) AS mean, round(stddev_samp(mae_mean), 5) AS std,
               round(min(mae_mean), 6) AS min, round(max(mae_mean), 6) AS max FROM e GROUP BY 1
        UNION ALL
        SELECT event_type, 'drift', round(avg(mae_drift), 6), round(stddev_samp(mae_drift), 5),
               round(min(mae_drift), 6), round(max(mae_drift), 6) FROM e GROUP BY 1"""
)
def cv_summaries(spark, sf_dir):
    """All folds of growing windows at once, from running sums."""
    tsf, out = by_type(spark, sf_dir), None
    for name, model in (("mean", NaiveMean()), ("drift", Drift())):
        _, summary = evaluate(model, tsf, expanding_folds(initial_window=10), ["mae"])
        part = summary.drop("metric").withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(rounded(out, "mean", "min", "max"), "std", digits=5)


@query(
    f"""WITH {TYPE_POS}, f AS (SELECT unnest(generate_series(0, 4)) AS fold),
        t AS (SELECT event_type, fold, n, regr_slope(y, pos) AS b, regr_intercept(y, pos) AS a
              FROM p, f WHERE pos < n - 5 + fold GROUP BY 1, 2, 3)
        SELECT p.event_type, fold, CAST(1 AS INTEGER) AS h, ts, y, round(a + b * pos, 6) AS yhat
        FROM p JOIN t ON t.event_type = p.event_type AND p.pos = p.n - 5 + fold"""
)
def cv_trend_running(spark, sf_dir):
    out = cv_predictions(Trend(), by_type(spark, sf_dir), expanding_folds(cv_folds=5))
    return rounded(out, "yhat")


@query(
    f"""WITH {TYPE_POS}, f AS (SELECT unnest(generate_series(14, 28, 7)) AS e),
        t AS (SELECT event_type, e, avg(y) AS m FROM p, f WHERE pos >= e - 14 AND pos < e AND e <= n - 2 GROUP BY 1, 2)
        SELECT p.event_type, (e - 14) // 7 AS fold, CAST(pos - e + 1 AS INTEGER) AS h, ts, y, round(m, 6) AS yhat
        FROM p JOIN t ON t.event_type = p.event_type AND pos - e + 1 IN (1, 2)"""
)
def cv_sliding_mean(spark, sf_dir):
    out = cv_predictions(NaiveMean(), by_type(spark, sf_dir), sliding_folds(14, step=7, fh=(1, 2)))
    return rounded(out, "yhat")


@query(
    f"""WITH RECURSIVE {TYPE_POS}, g AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS alpha),
        r AS (SELECT event_type, pos, n, CAST(alpha AS DOUBLE) AS alpha, y AS level, CAST(0 AS DOUBLE) AS sse
              FROM p, g WHERE pos = 0
              UNION ALL
              SELECT r.event_type, q.pos, q.n, alpha, alpha * q.y + (1 - alpha) * level,
                     sse + (q.y - level) * (q.y - level)
              FROM r JOIN p q ON q.event_type = r.event_type AND q.pos = r.pos + 1),
        b AS (SELECT * FROM r WHERE pos >= n - 4 AND pos < n - 1
              QUALIFY row_number() OVER (PARTITION BY event_type, pos ORDER BY sse, alpha) = 1)
        SELECT p.event_type, p.pos - (p.n - 3) AS fold, CAST(1 AS INTEGER) AS h, ts, y, round(level, 6) AS yhat
        FROM p JOIN b ON b.event_type = p.event_type AND b.pos = p.pos - 1"""
)
def cv_refit(spark, sf_dir):
    """Smoothing has no running form, so it is fitted again for each fold."""
    return rounded(cv_predictions(SES(), by_type(spark, sf_dir), expanding_folds(cv_folds=3)), "yhat")


_SMOOTH = f"""{TYPE_POS}, s AS (
  SELECT event_type, pos, alpha, CAST(y AS DOUBLE) AS level, CAST(0 AS DOUBLE) AS sse
  FROM p, (SELECT unnest({list(ALPHAS)}) AS alpha) WHERE pos = 0
  UNION ALL
  SELECT p.event_type, p.pos, alpha, level + alpha * (p.y - level), sse + (p.y - level) * (p.y - level)
  FROM s JOIN p ON p.event_type = s.event_type AND p.pos = s.pos + 1),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY event_type, pos ORDER BY sse, alpha) = 1)"""


@query(
    f"""WITH RECURSIVE {_SMOOTH}
        SELECT p.event_type, p.pos - 10 AS fold, CAST(1 AS INTEGER) AS h, ts, y, round(level, 5) AS yhat,
               round(sqrt(sse / (p.pos - 1)), 5) AS sigma
        FROM p JOIN b ON b.event_type = p.event_type AND b.pos = p.pos - 1 WHERE p.pos >= 10"""
)
def cv_smoothing_running(spark, sf_dir):
    """Simple smoothing at every cutoff, its weight chosen anew for each, from one pass."""
    folds = expanding_folds(initial_window=10)
    return rounded(cv_predictions(SES(), by_type(spark, sf_dir), folds, spread=True), "yhat", "sigma", digits=5)


@query(
    f"""WITH {TYPE_POS}, l AS (SELECT *, lag(y) OVER (PARTITION BY event_type ORDER BY pos) AS x FROM p),
        m AS (
          SELECT event_type, pos + 1 AS e, y AS last, regr_slope(y, x) OVER w AS phi, regr_intercept(y, x) OVER w AS a,
            regr_syy(y, x) OVER w AS syy, regr_sxy(y, x) OVER w AS sxy, regr_sxx(y, x) OVER w AS sxx
          FROM l WINDOW w AS (PARTITION BY event_type ORDER BY pos))
        SELECT p.event_type, p.pos - 10 AS fold, CAST(1 AS INTEGER) AS h, ts, y, round(a + phi * last, 4) AS yhat,
               round(sqrt((syy - sxy * sxy / sxx) / (e - 3)), 4) AS sigma
        FROM p JOIN m ON m.event_type = p.event_type AND m.e = p.pos WHERE p.pos >= 10"""
)
def cv_ar_running(spark, sf_dir):
    """A first-order autoregression at every cutoff, from running lag moments."""
    folds = expanding_folds(initial_window=10)
    return rounded(cv_predictions(AR1(), by_type(spark, sf_dir), folds, spread=True), "yhat", "sigma", digits=4)


_LEVELS = ", ".join(f"{{'a': {i / 100}, 'z': {NormalDist().inv_cdf(i / 100)!r}}}" for i in range(1, 100))
_Z = NormalDist().inv_cdf(0.95)


def _normal_sql(cte: str, rows: str) -> str:
    """Scores of rows (event_type, fold, y, mu, sigma)."""
    loss = lambda a, z: f"greatest({a} * (y - mu - {z} * sigma), ({a} - 1) * (y - mu - {z} * sigma))"
    return f"""WITH RECURSIVE {cte}, f AS ({rows})
        SELECT event_type, fold, avg(CAST(abs(y - mu) <= {_Z!r} * sigma AS DOUBLE)) AS coverage,
          round(avg(({loss(0.05, -_Z)} + {loss(0.95, _Z)}) / 2), 5) AS pinball,
          round(avg(2 * list_sum(list_transform([{_LEVELS}], lambda g: {loss("g.a", "g.z")})) / 99), 5) AS crps
        FROM f GROUP BY 1, 2"""


_LAST_ROWS = """SELECT event_type, pos - 10 AS fold, y, mu, sqrt(sse / (pos - 1)) AS sigma FROM (
    SELECT event_type, pos, y, lag(y) OVER w AS mu, sum(d * d) OVER (PARTITION BY event_type ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sse
    FROM (SELECT *, y - lag(y) OVER (PARTITION BY event_type ORDER BY pos) AS d FROM p)
    WINDOW w AS (PARTITION BY event_type ORDER BY pos)) WHERE pos >= 10"""


def _normal_scores(spark, sf_dir, model):
    folds, names = expanding_folds(initial_window=10), ["coverage", "pinball", "crps"]
    scores, _ = evaluate(model, by_type(spark, sf_dir), folds, names)
    return rounded(scores, "pinball", "crps", digits=5)


@query(_normal_sql(TYPE_POS, _LAST_ROWS))
def evaluate_crps(spark, sf_dir):
    """Interval, quantile and distribution scores of every fold of the last value."""
    return _normal_scores(spark, sf_dir, NaiveLast())


@query(
    _normal_sql(
        _SMOOTH,
        """SELECT p.event_type, p.pos - 10 AS fold, y, level AS mu, sqrt(sse / (p.pos - 1)) AS sigma
           FROM p JOIN b ON b.event_type = p.event_type AND b.pos = p.pos - 1 WHERE p.pos >= 10""",
    )
)
def evaluate_crps_smoothing(spark, sf_dir):
    return _normal_scores(spark, sf_dir, SES())
