"""Similar rows and neighbours where rows are many and alike."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.operators import panel as P
from chronoloom.operators.search import similar


def _brute(rows, k):
    """The k rows of the category with most equal tags; ids may have several rows."""
    out = set()
    for i in {r[0] for r in rows}:
        best = {}
        for a in (r for r in rows if r[0] == i):
            for b in (b for b in rows if b[2] == a[2] and b[0] != i):
                key = (b[1], b[0])
                best[key] = max(best.get(key, 0), sum(x == y for x, y in zip(a[3:], b[3:])))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out |= {(i, n + 1, o, s) for n, ((_, o), s) in enumerate(ranked)}
    return out


def test_similar_reads_files_once_for_a_profile(spark):
    rng = random.Random(8)
    rows = [(i, f"n{rng.randint(0, 9)}", "x", rng.choice("ab"), rng.choice([1, None])) for i in range(400)]
    out = similar(spark.createDataFrame(rows, "id int, name string, task string, t1 string, t2 int"), "id", "name", "task", ["t1", "t2"], 3)
    got = {(r["id"], r["rank"], r["other"], r["score"]) for r in out.collect()}
    assert got == _brute(rows, 3)
    # Neither files nor profiles are collected on the driver for a broadcast.
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_similar_with_an_id_of_several_names(spark):
    rows = [(0, n, "x", "a") for n in "abc"] + [(i, f"d{i}", "x", "ab"[i % 2]) for i in range(1, 9)]
    out = similar(spark.createDataFrame(rows, "id int, name string, task string, t1 string"), "id", "name", "task", ["t1"], 4)
    assert {r["id"]: 4 for r in out.collect()} == {i: 4 for i in range(9)}


def _nearest(rows, k):
    v = np.array([r[1] for r in rows])
    out = set()
    for a, (name, *_) in enumerate(rows):
        d = np.round(np.sqrt(((v - v[a]) ** 2).sum(1)), P.DIGITS)
        best = sorted((x, rows[b][0]) for b, x in enumerate(d) if rows[b][0] != name)[:k]
        out |= {(name, i + 1, other, x) for i, (x, other) in enumerate(best)}
    return out


@pytest.mark.parametrize("offset, scale", [(0.0, 1.0), (1e6, 1.0), (0.0, 1e18), (0.0, 1e-7)])
def test_neighbours_of_texts_with_copies(spark, monkeypatch, offset, scale):
    """Rough products rule out nothing that is near enough, and ties go by name; pieces are tiny."""
    monkeypatch.setattr(P, "PIECE_VALUES", 500)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(160, 12)) * scale + offset
    v[:60] = v[0]
    v[60:80] = v[0] + scale * 1e-3
    rows = [(f"n{i:03d}"[::-1], x.tolist(), i % 3) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "id string, values array<double>, label int")
    got = {(r.id, r.rank, r.neighbour): r.distance for r in P.nearest(df, df, 4, 8, 6).collect()}
    want = {x[:3]: x[3] for x in _nearest(rows, 4)}
    assert got.keys() == want.keys() and np.allclose([got[x] for x in want], [*want.values()], rtol=1e-12)


def test_a_query_that_visits_all_cells_is_copied_once_for_a_side(spark):
    """Not once for each of the cells, and a side gives back k rows for it."""
    rng = np.random.default_rng(6)
    rows = [(i, x.tolist(), 0) for i, x in enumerate(rng.normal(size=(320, 16)))]
    df = spark.createDataFrame(rows, "id bigint, values array<double>, label int")
    index = P.pivot_index(df, pivots=32, block_rows=20)
    first, count, _ = P._slabs(index, 80)
    slabs = max(first[c] + count[c] for c in first)
    assert slabs <= 8 < len(index.cells)
    cells = F.array(*[F.lit(int(c)) for c, *_ in index.cells])
    asked = df.select("id", "values", cells.alias("cells"), F.lit(None).cast("double").alias("bound"))
    found = P._search(asked, index, 2, "bigint", 80)
    assert found.count() == 320 * 2 * slabs
    best = {(r.id, r.rank, r.neighbour, r.distance) for r in P._best(found, 2).collect()}
    assert {x[:3] for x in best} == {x[:3] for x in _nearest(rows, 2)}
