"""Runs registered queries against DuckDB: `python -m tests.compare [names…]`."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool):
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_cell, v)) + "]"
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), sorted(names)


def compare(spark, con, sf_dir, fn, sql):
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got, got_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con.execute(sql)
    names = [d[0] for d in con.description]
    want, want_names = rows_of(names, con.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; e.g. {(set(got) ^ set(want)).pop()}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}"
    return None if got else "both empty"


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from chronoloom.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(8), duck(sf_dir)
    failed = 0
    names = [n for n in queries() if not argv or any(n.startswith(a) for a in argv)]
    for name in names:
        start = time.time()
        try:
            if name in oracle_sql():
                problem = compare(spark, con, sf_dir, queries()[name], oracle_sql()[name])
            else:
                n = queries()[name](spark, sf_dir).count()
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
