"""The stages of the pipeline against plain versions, each on its own input."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from chronoloom.llm import pieces, quality
from tests.llm import plain

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    marks = {r.doc_id: r.quality for r in quality.measure(docs).collect()}
    want = {i: q.cleaned for i, q in marks.items() if q.kept}
    groups = plain.jaccard(sorted(want.items()), percent=80, words=5)
    chosen = {i: t for i, t in want.items() if groups[i][0] == 0 or groups[i][1] == i}
    cut = {}
    for i, n, removed, kept in plain.passages(sorted(chosen.items())):
        if not n or removed < n:
            cut[i] = " ".join(kept) if removed else chosen[i]
    dirty = {r[0] for r in plain.contamination(sorted(cut.items()), items) if r[5]}
    last = {i: t for i, t in cut.items() if i not in dirty}
    at = docs
    for (name, stage), kept in zip(P.STAGES[:4], (want, chosen, cut, last)):
        at = stage(spark, at, SF_DIR).cache()
        assert at.columns == docs.columns, name
        assert {r.doc_id: r.text for r in at.collect()} == kept, name
        assert at.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert 0 < len(last) < len(want) < docs.count() and dirty
    v = pieces.vocabulary(pieces.MODEL)
    rows = P.run(spark, SF_DIR).collect()
    assert {r.doc_id: pieces.decode_ids(v, np.array(r.pieces)) for r in rows} == last
    assert all(r.lossless for r in rows)


def test_near_duplicates_by_five_words(spark):
    base = [f"w{i}" for i in range(250)]
    near = [f"n{i}" if i in (20, 70, 120, 170, 220) else w for i, w in enumerate(base)]
    short = [f"s{i}" for i in range(50)]
    rows = [(1, base), (2, near), (3, short), (4, [*short[:25], "other", *short[26:]]), (5, base[:200]), (6, base[:190])]
    rows = [(i, " ".join(w)) for i, w in rows]
    docs = spark.createDataFrame([(i, x, len(x)) for i, x in rows], "doc_id bigint, text string, n_chars bigint")
    kept = sorted(r.doc_id for r in P.near_duplicates(spark, docs, SF_DIR).collect())
    want = sorted(i for i, (_, c) in plain.jaccard(rows, percent=80, words=5).items() if c == i)
    assert kept == want == [1, 3, 5]


def test_queries_exist():
    from __spark_entry__ import oracle_sql, queries

    names = set(queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(oracle_sql()) <= names
