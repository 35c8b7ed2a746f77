"""Splits, folds and history at cutoffs."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.operators.split import (
    cutoff_folds, cutoff_rows, expanding_folds, history_at, sliding_folds, temporal_split,
)
from chronoloom.plans.panels import (
    BY_PRIORITY, BY_TYPE, PRIORITY_POS, TYPE_POS, USER_POS, by_priority, by_type, by_user,
)
from chronoloom.plans.registry import query, rounded
from chronoloom.sources.datasets import table


@query(
    f"""WITH {USER_POS} SELECT user_id, ts, y,
        CASE WHEN pos >= n - greatest(1, CAST(floor(n * 0.2) AS BIGINT)) THEN 'test' ELSE 'train' END AS split
        FROM p WHERE greatest(1, CAST(floor(n * 0.2) AS BIGINT)) < n"""
)
def split_fraction(spark, sf_dir):
    return temporal_split(by_user(spark, sf_dir), test_size=0.2).marked


@query(f"WITH {PRIORITY_POS} SELECT priority, ts, y FROM p WHERE pos >= n - 10 AND n > 10")
def split_horizon_test(spark, sf_dir):
    return temporal_split(by_priority(spark, sf_dir), fh=[1, 5, 10]).test.df


@query(f"WITH {PRIORITY_POS} SELECT priority, ts, y FROM p WHERE pos < n - 12 AND n > 12")
def split_horizon_train(spark, sf_dir):
    return temporal_split(by_priority(spark, sf_dir), fh=12).train.df


@query(
    f"""WITH {USER_POS} SELECT DISTINCT user_id, n, CAST(28 AS BIGINT) AS n_test,
        'test set as long as the series' AS reason FROM p WHERE n <= 28"""
)
def split_rejected(spark, sf_dir):
    return temporal_split(by_user(spark, sf_dir), fh=28).rejected


@query(
    f"""WITH {PRIORITY_POS} SELECT priority, count(*) FILTER (WHERE pos < n - 12) AS train_size,
        count(*) FILTER (WHERE pos >= n - 12) AS n_test, max(ts) FILTER (WHERE pos < n - 12) AS cutoff
        FROM p WHERE n > 12 GROUP BY 1"""
)
def split_sizes(spark, sf_dir):
    return temporal_split(by_priority(spark, sf_dir), fh=12).sizes()


@query(
    f"""WITH {BY_PRIORITY}, s AS (SELECT priority, count(*) AS n FROM by_priority GROUP BY 1),
        f AS (SELECT priority, n, unnest(generate_series(60, n - 1)) AS e FROM s)
        SELECT priority, e - 60 AS fold, CAST(0 AS BIGINT) AS train_start, e AS train_end, n FROM f"""
)
def folds_expanding(spark, sf_dir):
    return expanding_folds(initial_window=60).table(by_priority(spark, sf_dir))


@query(
    f"""WITH {BY_PRIORITY}, s AS (SELECT priority, count(*) AS n FROM by_priority GROUP BY 1),
        f AS (SELECT priority, n, unnest(generate_series(24, n - 3, 12)) AS e FROM s)
        SELECT priority, (e - 24) // 12 AS fold, e - 24 AS train_start, e AS train_end, n FROM f"""
)
def folds_sliding(spark, sf_dir):
    return sliding_folds(24, step=12, fh=(1, 2, 3)).table(by_priority(spark, sf_dir))


@query(
    f"""WITH {PRIORITY_POS}, s AS (SELECT priority, count(*) AS n FROM by_priority GROUP BY 1),
        f AS (SELECT priority, unnest(generate_series(24, n - 3, 12)) AS e FROM s)
        SELECT p.priority, ts, y, pos, (e - 24) // 12 AS fold,
               CASE WHEN pos < e THEN 'train' ELSE 'test' END AS "role",
               CAST(CASE WHEN pos < e THEN 0 ELSE pos - e + 1 END AS INTEGER) AS h
        FROM p JOIN f ON p.priority = f.priority
        WHERE (pos >= e - 24 AND pos < e) OR pos - e + 1 IN (1, 3)"""
)
def fold_rows_sliding(spark, sf_dir):
    return sliding_folds(24, step=12, fh=(1, 3)).expand(by_priority(spark, sf_dir))


@query(
    f"""WITH {TYPE_POS}, f AS (SELECT unnest([0, 1, 2]) AS fold)
        SELECT event_type, ts, y, pos, CAST(fold AS BIGINT) AS fold,
               CASE WHEN pos < n - 3 + fold THEN 'train' ELSE 'test' END AS "role",
               CAST(CASE WHEN pos < n - 3 + fold THEN 0 ELSE 1 END AS INTEGER) AS h
        FROM p, f WHERE pos <= n - 3 + fold"""
)
def fold_rows_expanding(spark, sf_dir):
    return expanding_folds(cv_folds=3).expand(by_type(spark, sf_dir))


@query(f"WITH {BY_PRIORITY} SELECT priority, greatest((count(*) - 36) // 6 + 1, 0) AS n_folds FROM by_priority GROUP BY 1")
def fold_count(spark, sf_dir):
    # Horizon 12 after a first window of 24, moving by 6.
    folds = expanding_folds(initial_window=24, step=6, fh=(1, 12))
    return folds.counts(by_priority(spark, sf_dir))


_CUTS = """c AS (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS cutoff FROM events
  WHERE value > 200 GROUP BY 1, 2)"""


def _cutoffs(spark, sf_dir):
    """Days with an unusually large event, per type."""
    return table(spark, sf_dir, "events").where("value > 200").select(
        "event_type", F.to_date("ts").cast("timestamp_ntz").alias("cutoff")
    ).distinct()


@query(
    f"""WITH {TYPE_POS}, {_CUTS}, s AS (SELECT event_type, count(*) AS n FROM by_type GROUP BY 1),
        e AS (SELECT c.event_type, c.cutoff, count(*) AS train_end FROM c
              JOIN by_type b ON b.event_type = c.event_type AND b.ts <= c.cutoff GROUP BY 1, 2)
        SELECT event_type, cutoff, train_end, n FROM e JOIN s USING (event_type) WHERE n - train_end >= 2"""
)
def folds_cutoff(spark, sf_dir):
    return cutoff_folds(by_type(spark, sf_dir), _cutoffs(spark, sf_dir), fh=(1, 2))


@query(
    f"""WITH {TYPE_POS}, {_CUTS},
        e AS (SELECT c.event_type, c.cutoff, count(*) AS train_end FROM c
              JOIN by_type b ON b.event_type = c.event_type AND b.ts <= c.cutoff GROUP BY 1, 2)
        SELECT p.event_type, ts, y, pos, cutoff, CASE WHEN pos < train_end THEN 'train' ELSE 'test' END AS "role",
               CAST(CASE WHEN pos < train_end THEN 0 ELSE pos - train_end + 1 END AS INTEGER) AS h
        FROM p JOIN e ON p.event_type = e.event_type
        WHERE n - train_end >= 2 AND pos <= train_end + 1"""
)
def fold_rows_cutoff(spark, sf_dir):
    return cutoff_rows(by_type(spark, sf_dir), _cutoffs(spark, sf_dir), fh=(1, 2))


@query(
    f"""WITH {BY_TYPE}, {_CUTS}
        SELECT c.event_type, cutoff, count(b.ts) AS rows_before, round(avg(b.y), 6) AS mean_before
        FROM c LEFT JOIN by_type b ON b.event_type = c.event_type AND b.ts < c.cutoff GROUP BY 1, 2"""
)
def history_before_cutoff(spark, sf_dir):
    return rounded(history_at(by_type(spark, sf_dir), _cutoffs(spark, sf_dir)), "mean_before")
