"""Panel learning, detection, search and exact quantiles against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.functions.quantiles import exact_quantiles
from chronoloom.operators import panel
from chronoloom.operators.detect import change_points, hampel
from chronoloom.operators.search import (
    _suggest_by_deletions, capability_filter, explain_tags, meets, page, ranked_search, similar, suggest,
    tag_category, tag_filter,
)
from chronoloom.operators.transform import seasonality
from tests.helpers import daily_panel, monthly


def points(n, seed, crowd=0):
    """Vectors of which `crowd` are the same one."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 6)) + rng.integers(0, 3, size=(n, 1)) * 4
    v[:crowd] = v[0]
    return [(i, [float(x) for x in row], int(i % 3)) for i, row in enumerate(v)]


@pytest.mark.parametrize("block,crowd,k", [(8192, 0, 3), (16, 0, 4), (16, 60, 5)])
def test_nearest_is_exact(spark, monkeypatch, block, crowd, k):
    monkeypatch.setattr(panel, "BLOCK_ROWS", block)
    monkeypatch.setattr(panel, "PIVOTS", 8)
    data = points(150, 1, crowd)
    df = spark.createDataFrame(data, "id bigint, values array<double>, label int")
    got = {}
    for r in panel.nearest(df, df, k).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["neighbour"], r["label"])
    v = np.array([d[1] for d in data])
    for i in range(len(data)):
        d = np.round(np.sqrt(((v - v[i]) ** 2).sum(1)), panel.DIGITS)
        want = sorted((x, j) for j, x in enumerate(d) if j != i)[:k]
        assert [got[i][r + 1] for r in range(k)] == [(j, j % 3) for _, j in want]


def test_neighbours_fewer_than_k(spark):
    df = spark.createDataFrame(points(3, 2), "id bigint, values array<double>, label int")
    assert panel.nearest(df, df, 9).count() == 6
    assert panel.nearest(df, df, 9).select("label").distinct().count() == 3
    with pytest.raises(ValueError, match="empty"):
        panel.nearest(df, df.limit(0), 1)


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame(points(60, 3), "id bigint, values array<double>, label int")
    for out in (panel.knn_proba(df, df, 5), panel.forest_classify(df, df, trees=5)):
        sums = out.groupBy("id").agg(F.sum("probability").alias("s"), F.count("label").alias("n"))
        assert sums.where("abs(s - 1) > 1e-9 or n <> 3").count() == 0
    assert panel.cluster(df, 3).select("cluster").distinct().count() == 3
    assert panel.forest_regress(df, df, trees=5).count() == 60


def test_instances_from_series(spark):
    tsf = daily_panel(spark, 1000, holes=False, nulls=False)
    assert {r["id"]: len(r["values"]) for r in panel.from_series(tsf).collect()} == {"long": 90, "mid": 25, "one": 1}


def test_hampel_finds_the_spike(spark):
    out = hampel(monthly(spark, [10, 11, 10, 12, 90, 11, 10, 12, 11]), 3, 3.0)
    assert [r["y"] for r in out.where("anomaly").collect()] == [90.0]


def test_change_points_are_found_in_turn(spark):
    values = [0.0] * 10 + [20.0] * 10 + [5.0] * 10
    got = change_points(monthly(spark, values), 3).orderBy("round").collect()
    assert sorted(r["pos"] for r in got) == [9, 19]


def test_seasonality(spark):
    assert seasonality(monthly(spark, [i % 4 for i in range(40)]), 10).first()["sp"] == 4


@pytest.mark.parametrize("kind", ["spread", "crowded", "same", "infinite"])
def test_long_quantiles(spark, kind):
    rng = random.Random(5)
    draw = {
        "spread": lambda: rng.gauss(0, 100), "crowded": lambda: 1e6 if rng.random() < 0.02 else rng.random(),
        "same": lambda: rng.choice([1.0, 2.0]),
        "infinite": lambda: rng.choice([float("inf"), float("-inf"), rng.random(), rng.random()]),
    }[kind]
    values = [draw() for _ in range(400)]
    tsf = monthly(spark, values, max_rows=10)
    assert tsf.width > 0
    probs = [0.3, 0.5, 0.7] if kind == "infinite" else [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    assert np.allclose(exact_quantiles(tsf, probs).first()["q"], np.quantile(values, probs), rtol=1e-12)


# -- search ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def catalog(spark):
    rng = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta"]
    rows = []
    for i in range(120):
        tags = {"pred": rng.choice(["true", "false"]), "kind": rng.choice("ab")}
        rows.append((i, f"{rng.choice(words)}{rng.choice(words)}", rng.choice(words), rng.choice(["x", "y"]), tags))
    return spark.createDataFrame(rows, "id int, name string, module string, task string, tags map<string,string>")


def test_ranked_search(catalog):
    got = ranked_search(catalog, "BETA", ["name", "module"]).collect()
    for r in got:
        want = 1 if r["name"].startswith("beta") else 2 if "beta" in r["name"] else 3
        assert r["score"] == want and (want < 3 or "beta" in r["module"])
    assert len(got) == sum("beta" in r["name"] or "beta" in r["module"] for r in catalog.collect())
    assert ranked_search(catalog, "b%ta", ["name"]).count() == 0


def test_tags(catalog):
    want = sum(r["tags"]["pred"] == "true" and r["task"] == "x" for r in catalog.collect())
    assert tag_filter(catalog, {"pred": "true"}, ("task", "x")).count() == want
    assert tag_filter(catalog, '{"pred": "true", "none": "1"}').count() == 0
    assert capability_filter(catalog, {"probabilistic": "pred"}, probabilistic=True).count() > 0
    with pytest.raises(ValueError):
        tag_filter(catalog, "[1]")
    with pytest.raises(ValueError):
        capability_filter(catalog, nope=True)


def test_page(catalog):
    first = page(catalog, ["name", "id"], limit=50).collect()
    last = page(catalog, ["name", "id"], limit=50, offset=100).collect()
    assert (len(first), first[0]["total"], first[0]["has_more"]) == (50, 120, True)
    assert (len(last), last[0]["has_more"]) == (20, False)
    for bad in ({"limit": 0}, {"offset": -1}):
        with pytest.raises(ValueError):
            page(catalog, ["id"], **bad)


def test_suggestions_agree(spark):
    rng = random.Random(2)
    keys = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(80)]
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["zzzzzzzz"]
    w = spark.createDataFrame([(x,) for x in words], "w string")
    k = spark.createDataFrame([(x,) for x in keys], "k string")
    direct = {r["word"]: (r["suggestion"], r["distance"]) for r in suggest(w, k, 2).collect()}
    joined = _suggest_by_deletions(w.select(F.col("w").alias("word")).distinct(), k.select(F.col("k").alias("key")).distinct(), 2)
    other = {r["word"]: (r["suggestion"], r["distance"]) if r["distance"] is not None and r["distance"] <= 2 else (None, None) for r in joined.collect()}
    assert direct == other and direct["zzzzzzzz"] == (None, None)


def test_explain_and_meets(spark, catalog):
    defs = spark.createDataFrame([("pred", "Gives intervals", "bool")], "tag string, description string, value_type string")
    got = {(r["tag"], r["explanation"]) for r in explain_tags(catalog, defs, "id").collect()}
    assert got == {("pred", "Gives intervals: Yes"), ("pred", "Gives intervals: No"), ("kind", "kind: a"), ("kind", "kind: b")}
    met = meets(catalog, {"kind": "a", "none": "1"}, "id")
    assert met.where("requirement = 'none' and met").count() == 0 and met.count() == 240


def test_categories(spark):
    names = ["capability:x", "scitype:y", "requires_z", "transform-a", "python_version", "X_inner_mtype", "other"]
    df = spark.createDataFrame([(n, "forecaster" if n == "other" else None) for n in names], "n string, s string")
    got = [r[0] for r in df.select(tag_category(F.col("n"), F.col("s"))).collect()]
    assert got == ["capability", "data", "behavior", "transformation", "requirements", "data", "forecaster"]


def test_similar_is_exact(spark):
    rng = random.Random(4)
    rows = [(i, f"n{rng.randint(0, 30)}", rng.choice("xy"), rng.choice("ab"), rng.choice([1, None, 2]), "same") for i in range(90)]
    df = spark.createDataFrame(rows, "id int, name string, task string, t1 string, t2 int, t3 string")
    got = {}
    for r in similar(df, "id", "name", "task", ["t1", "t2", "t3"], 4).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["other"], r["score"])
    for a in rows:
        scored = [(-sum(x == y for x, y in zip(a[3:], b[3:])), b[1], b[0]) for b in rows if b[2] == a[2] and b[0] != a[0]]
        assert [got[a[0]][i + 1] for i in range(4)] == [(o, -s) for s, _, o in sorted(scored)[:4]]
