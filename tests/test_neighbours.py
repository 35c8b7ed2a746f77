"""Nearest neighbours against brute force, with blocks of any size and a saved index."""

import numpy as np
import pytest

from chronoloom.operators import panel as P


def rows(n, seed=1, clumps=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clumps, 4)) * 20
    values = centres[rng.integers(0, clumps, n)] + rng.normal(size=(n, 4))
    values[: n // 5] = values[0]  # a fifth of all rows is the same
    return [(i, v.tolist(), i % 3) for i, v in enumerate(values)]


def brute(queries, train, k):
    out = set()
    for q, v, _ in queries:
        d = sorted((round(float(np.sqrt(((np.array(v) - np.array(t)) ** 2).sum())), 9), n) for n, t, _ in train if n != q)
        out |= {(q, r + 1, n, x) for r, (x, n) in enumerate(d[:k])}
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "id bigint, values array<double>, label int")


@pytest.mark.parametrize("block_rows, pivots, k", [(8_192, 64, 5), (7, 9, 5), (16, 3, 40), (3, 64, 1)])
def test_exact(spark, block_rows, pivots, k):
    train, queries = rows(150), rows(40, seed=2)
    for q in (queries, train[:60]):
        got = P.nearest(frame(spark, q), frame(spark, train), k, block_rows, pivots).collect()
        assert {(r.id, r.rank, r.neighbour, r.distance) for r in got} == brute(q, train, k)
        assert all(r.label == r.neighbour % 3 for r in got)


def test_fewer_rows_than_asked(spark):
    train = rows(4)
    got = P.nearest(frame(spark, train), frame(spark, train), 9, pivots=2).collect()
    assert {(r.id, r.rank, r.neighbour, r.distance) for r in got} == brute(train, train, 9)
    assert P.nearest(frame(spark, []), frame(spark, train), 2).collect() == []
    with pytest.raises(ValueError):
        P.nearest(frame(spark, train), frame(spark, []), 2)


def test_saved_index(spark, tmp_path):
    train, queries = rows(120), rows(30, seed=5)
    index = P.pivot_index(frame(spark, train), pivots=12, block_rows=10)
    index.save(f"{tmp_path}/index")
    loaded = P.load_index(spark, f"{tmp_path}/index")
    assert loaded.cells == index.cells and np.array_equal(loaded.pivots, index.pivots)
    got = P.nearest(frame(spark, queries), loaded, 3, block_rows=10).collect()
    assert {(r.id, r.rank, r.neighbour, r.distance) for r in got} == brute(queries, train, 3)


def test_training_rows_are_packed_once(spark):
    """The number of queries does not multiply the training side."""
    index = P.pivot_index(frame(spark, rows(400)), pivots=8, block_rows=50)
    assert index.blocks.count() <= sum(parts for _, _, parts, _ in index.cells)
    assert index.blocks.selectExpr("sum(size(names))").first()[0] == 400
    few, many = rows(10, seed=3), rows(300, seed=3)
    plans = [P.nearest(frame(spark, q), index, 2, 50)._jdf.queryExecution().optimizedPlan().toString() for q in (few, many)]
    assert all("CartesianProduct" not in p and "Join Cross" not in p for p in plans)


def test_many_classes(spark):
    train = [(i, [float(i)], 100_000 + i) for i in range(50)]
    got = P.knn_proba(frame(spark, train[:3]), frame(spark, train), 2).collect()
    assert len(got) == 150 and sum(r.probability for r in got) == 3.0
