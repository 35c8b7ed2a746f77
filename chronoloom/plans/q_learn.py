"""Transformers, features, panel learning and detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.operators.detect import change_points, hampel
from chronoloom.operators.panel import (
    cluster, forest_classify, forest_regress, knn_classify, knn_proba, knn_regress, mean_regress, nearest,
)
from chronoloom.operators.transform import (
    LAMBDAS, BoxCox, Deseasonalise, Detrend, Log, lags_and_rolling, seasonality, summary_features,
)
from chronoloom.plans.panels import PRIORITY_POS, TYPE_POS, USER_POS, by_priority, by_type, by_user
from chronoloom.plans.q_forecast import SEASON_SQL
from chronoloom.plans.registry import flag, query, rounded
from chronoloom.sources.datasets import dataset

# -- transformers ---------------------------------------------------------------


@query(
    f"""WITH {PRIORITY_POS}, m AS (
          SELECT priority, regr_slope(y, pos) AS b, regr_intercept(y, pos) AS a FROM p GROUP BY 1)
        SELECT priority, ts, round(y - (a + b * pos), 6) AS y FROM p JOIN m USING (priority)"""
)
def detrend(spark, sf_dir):
    tsf, t = by_priority(spark, sf_dir), Detrend()
    return rounded(t.transform(tsf, t.fit(tsf)).df, "y")


@query(f"WITH {PRIORITY_POS} SELECT priority, ts, y FROM p")
def detrend_inverse(spark, sf_dir):
    tsf, t = by_priority(spark, sf_dir), Detrend()
    params = t.fit(tsf)
    return rounded(t.inverse(t.transform(tsf, params), params).df, "y", digits=4)


@query(
    f"""WITH {PRIORITY_POS}, {SEASON_SQL}
        SELECT p.priority, ts, round(y - s.s, 6) AS y FROM p JOIN s ON s.priority = p.priority AND s.slot = pos % 12"""
)
def deseasonalise_additive(spark, sf_dir):
    tsf, t = by_priority(spark, sf_dir), Deseasonalise(12)
    return rounded(t.transform(tsf, t.fit(tsf)).df, "y")


@query(
    f"""WITH {TYPE_POS}, c AS (SELECT *, avg(y) OVER (PARTITION BY event_type ORDER BY pos
            ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS cma FROM p),
        v AS (SELECT event_type, pos % 7 AS slot, avg(y / cma) AS v FROM c WHERE pos >= 3 AND pos < n - 3 GROUP BY 1, 2),
        s AS (SELECT event_type, slot, v / avg(v) OVER (PARTITION BY event_type) AS s FROM v)
        SELECT p.event_type, ts, round(y / s.s, 5) AS y
        FROM p JOIN s ON s.event_type = p.event_type AND s.slot = pos % 7"""
)
def deseasonalise_multiplicative(spark, sf_dir):
    tsf, t = by_type(spark, sf_dir), Deseasonalise(7, "multiplicative")
    return rounded(t.transform(tsf, t.fit(tsf)).df, "y", digits=5)


_LAMBDA_ROWS = ", ".join(f"({v})" for v in LAMBDAS)


@query(
    f"""WITH {PRIORITY_POS}, g(lam) AS (VALUES {_LAMBDA_ROWS}),
        z AS (SELECT priority, lam, ts, y, CASE WHEN lam = 0 THEN ln(y) ELSE (pow(y, lam) - 1) / lam END AS z FROM p, g),
        l AS (SELECT priority, lam, (lam - 1) * sum(ln(y)) - count(*) / 2 * ln(var_pop(z)) AS llf FROM z GROUP BY 1, 2),
        b AS (SELECT priority, max_by(lam, llf) AS lam FROM l GROUP BY 1)
        SELECT z.priority, ts, round(z, 6) AS y, CAST(z.lam AS DOUBLE) AS lam
        FROM z JOIN b ON b.priority = z.priority AND b.lam = z.lam"""
)
def boxcox_best(spark, sf_dir):
    tsf, t = by_priority(spark, sf_dir), BoxCox()
    params = t.fit(tsf)
    out = t.transform(tsf, params).df.join(params.select("priority", "p.lam"), "priority")
    return rounded(out, "y")


@query(f"WITH {TYPE_POS} SELECT event_type, ts, round(ln(y), 9) AS y FROM p")
def log_transform(spark, sf_dir):
    tsf, t = by_type(spark, sf_dir), Log()
    return rounded(t.transform(tsf, t.fit(tsf)).df, "y", digits=9)


_FEATURES = """round(avg(y), 6) AS mean, round(stddev_samp(y), 6) AS std, round(regr_slope(y, pos), 6) AS slope,
  min(y) AS min, max(y) AS max, round(quantile_cont(y, 0.25), 6) AS q25, round(quantile_cont(y, 0.5), 6) AS q50,
  round(quantile_cont(y, 0.75), 6) AS q75, round(corr(y, prev), 9) AS acf1"""


@query(
    f"""WITH {USER_POS}, l AS (SELECT *, lag(y) OVER (PARTITION BY user_id ORDER BY pos) AS prev FROM p)
        SELECT user_id, {_FEATURES} FROM l GROUP BY 1"""
)
def features_summary(spark, sf_dir):
    out = summary_features(by_user(spark, sf_dir))
    return rounded(rounded(out, "mean", "std", "slope", "q25", "q50", "q75"), "acf1", digits=9)


@query(
    f"""WITH {PRIORITY_POS}, i AS (SELECT *, CAST(pos * 4 // n AS INTEGER) AS "interval" FROM p),
        l AS (SELECT *, lag(y) OVER (PARTITION BY priority, "interval" ORDER BY pos) AS prev FROM i)
        SELECT priority, "interval", {_FEATURES} FROM l GROUP BY 1, 2"""
)
def features_interval(spark, sf_dir):
    out = summary_features(by_priority(spark, sf_dir), n_intervals=4)
    return rounded(rounded(out, "mean", "std", "slope", "q25", "q50", "q75"), "acf1", digits=9)


@query(
    f"""WITH {USER_POS} SELECT user_id, ts, y, lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7,
        y - lag(y, 1) OVER w AS diff_1,
        CASE WHEN pos >= 3 THEN round(avg(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) END AS mean_3,
        CASE WHEN pos >= 3 THEN round(stddev_samp(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 5) END AS std_3
        FROM p WINDOW w AS (PARTITION BY user_id ORDER BY pos)"""
)
def lags_rolling(spark, sf_dir):
    out = lags_and_rolling(by_user(spark, sf_dir), lags=(1, 7), diffs=(1,), windows=(3,)).df
    return rounded(rounded(out, "mean_3"), "std_3", digits=5)


_ACF = "\n UNION ALL ".join(
    f"SELECT priority, {k} AS sp, round(corr(y, l{k}), 9) AS acf FROM l GROUP BY 1" for k in range(2, 19)
)


@query(
    f"""WITH {PRIORITY_POS}, l AS (SELECT *, {', '.join(f'lag(y, {k}) OVER (PARTITION BY priority ORDER BY pos) AS l{k}' for k in range(2, 19))} FROM p),
        a AS ({_ACF})
        SELECT priority, CAST(sp AS INTEGER) AS sp, acf FROM a
        QUALIFY row_number() OVER (PARTITION BY priority ORDER BY acf DESC, sp) = 1"""
)
def season_length(spark, sf_dir):
    return seasonality(by_priority(spark, sf_dir), max_lag=18)


# -- detection ------------------------------------------------------------------


@query(
    f"""WITH {USER_POS}, w AS (SELECT user_id, ts, y, list(y) OVER (PARTITION BY user_id ORDER BY pos
            ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS ys FROM p),
        m AS (SELECT *, list_aggregate(ys, 'median') AS med FROM w),
        d AS (SELECT user_id, ts, y, med, list_aggregate(list_transform(ys, lambda v: abs(v - med)), 'median') AS mad FROM m)
        SELECT user_id, ts, y, med AS median, mad, CAST(abs(y - med) > 3.0 * 1.4826 * mad AS INTEGER) AS anomaly FROM d"""
)
def hampel_anomalies(spark, sf_dir):
    return hampel(by_user(spark, sf_dir), window=5, k=3.0).withColumn("anomaly", flag("anomaly"))


@query(
    f"""WITH {USER_POS}, s AS (SELECT *, sum(y) OVER (PARTITION BY user_id ORDER BY pos) AS s,
            sum(y) OVER (PARTITION BY user_id) AS total FROM p),
        g AS (SELECT user_id, pos, ts, (pos + 1) * (n - 1 - pos) / n
                * pow(s / (pos + 1) - (total - s) / (n - 1 - pos), 2) AS gain
              FROM s WHERE pos + 1 >= 3 AND n - 1 - pos >= 3)
        SELECT user_id, CAST(1 AS INTEGER) AS round, pos, ts, round(gain, 2) AS gain FROM g
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(gain, 9) DESC, pos) = 1"""
)
def change_point(spark, sf_dir):
    return rounded(change_points(by_user(spark, sf_dir), 1, min_size=3), "gain", digits=2)


def _cut_round(k: int) -> str:
    """Best split of round k; the splits before it number the segments."""
    after = [f"(SELECT count(*) FROM b{j} WHERE b{j}.priority = p.priority AND b{j}.pos < p.pos)" for j in range(1, k)]
    return f"""x{k} AS (SELECT priority, pos, ts, y, {' + '.join(after) or '0'} AS seg FROM p),
        y{k} AS (SELECT *, row_number() OVER w AS l, count(*) OVER v - row_number() OVER w AS r,
                   sum(y) OVER w AS s, sum(y) OVER v AS t FROM x{k}
                 WINDOW v AS (PARTITION BY priority, seg), w AS (PARTITION BY priority, seg ORDER BY pos)),
        z{k} AS (SELECT priority, pos, ts, l * r / (l + r) * pow(s / l - (t - s) / r, 2) AS gain
                 FROM y{k} WHERE l >= 3 AND r >= 3),
        b{k} AS (SELECT priority, CAST({k} AS INTEGER) AS round, pos, ts, round(gain, 2) AS gain FROM z{k} WHERE gain > 0
                 QUALIFY row_number() OVER (PARTITION BY priority ORDER BY round(gain, 9) DESC, pos) = 1)"""


@query(
    f"""WITH {PRIORITY_POS}, {', '.join(_cut_round(k) for k in (1, 2, 3))}
        SELECT * FROM b1 UNION ALL SELECT * FROM b2 UNION ALL SELECT * FROM b3"""
)
def change_points_three(spark, sf_dir):
    return rounded(change_points(by_priority(spark, sf_dir), 3, min_size=3), "gain", digits=2)


# -- panel learning, each instance against all others ---------------------------

_NEAREST = """d AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, b.label,
    round(sqrt(list_sum(list_transform(list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])),
      lambda p: (p[1] - p[2]) * (p[1] - p[2])))), 9) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
  r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM d),
  n AS (SELECT * FROM r WHERE rank <= 5)"""


def _panel(spark, sf_dir):
    return dataset(spark, sf_dir, "embeddings")


@query(f"WITH {_NEAREST} SELECT id, CAST(rank AS INTEGER) AS rank, neighbour, round(distance, 6) AS distance FROM n")
def nearest_series(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return rounded(nearest(panel, panel.drop("label"), 5), "distance")


@query(
    f"""WITH {_NEAREST}, v AS (SELECT id, label, count(*) AS votes FROM n GROUP BY 1, 2)
        SELECT id, label AS predicted FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY votes DESC, label) = 1"""
)
def knn_class(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return knn_classify(panel, panel, 5)


@query(
    f"""WITH {_NEAREST}, c AS (SELECT DISTINCT label FROM embeddings), i AS (SELECT DISTINCT id FROM n)
        SELECT i.id, c.label, round(count(n.neighbour) / 5, 6) AS probability
        FROM i CROSS JOIN c LEFT JOIN n ON n.id = i.id AND n.label = c.label GROUP BY 1, 2"""
)
def knn_probability(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return rounded(knn_proba(panel, panel, 5), "probability")


@query(f"WITH {_NEAREST} SELECT id, round(avg(label), 6) AS predicted FROM n GROUP BY 1")
def knn_mean(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return rounded(knn_regress(panel, panel, 5), "predicted")


@query("SELECT vec_id AS id, round((SELECT avg(label) FROM embeddings), 6) AS predicted FROM embeddings")
def mean_baseline(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return rounded(mean_regress(panel, panel), "predicted")


@query()
def forest_class(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return rounded(forest_classify(panel, panel, trees=20), "probability")


@query()
def forest_regression(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return rounded(forest_regress(panel, panel, trees=20), "predicted")


@query()
def series_clusters(spark, sf_dir):
    return cluster(_panel(spark, sf_dir), k=8)
