"""Byte-level BPE against the tiktoken library, with chunks of any size."""

import base64
import random
import time

import numpy as np
import pytest
import tiktoken

from chronoloom.llm import byte_bpe as B
from tests.llm import plain

SCHEMA = "doc_id bigint, text string, tokens string, row int, key string, part int"


@pytest.fixture(scope="module")
def library():
    with open(B.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(8)
    out = [None, "", " ", "\n\n  \n", "a", "it's we'll I'd 'll", "日本 🙂 text\x00\x1c\x85 x", "<|endoftext|>", "é" * 300, "1234567" * 90]
    parts = [*" \n\t'", "'ll", "'re", " the", "ab", "é", "12", "...", "  ", " 's", "日", "x" * 40]
    out += ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 600))) for _ in range(25)]
    return out + out[-2:]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "old", 3, "k", 4) for i, t in rows], SCHEMA)


def expected(library, rows):
    out = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        out.append((i, len(ids), plain.sha(",".join(map(str, ids))), plain.sha(t or "")))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk, overlap", [(B.CHUNK, B.OVERLAP), (50, 40), (64, 5), (9, 4)])
def test_round_trip(spark, library, chunk, overlap):
    rows = list(enumerate(texts())) + [(3, "again it's"), (None, "no id " * 30)]
    got = B.round_trip(frame(spark, rows), chunk=chunk, overlap=overlap).collect()
    assert sorted(map(tuple, got), key=str) == expected(library, rows)


@pytest.mark.parametrize("chunk, overlap", [(B.CHUNK, B.OVERLAP), (30, 10)])
def test_encode_keeps_columns_and_decodes(spark, library, chunk, overlap):
    rows = list(enumerate(texts()))
    coded = B.encode(frame(spark, rows), chunk=chunk, overlap=overlap)
    got = {r.doc_id: r for r in B.decode(coded).collect()}
    for i, t in rows:
        assert got[i].tokens == (None if t is None else library.encode_ordinary(t))
        assert got[i].decoded == (None if t is None else t.encode()) and (got[i].row, got[i].key, got[i].part) == (3, "k", 4)
    assert B.encode(frame(spark, [])).count() == B.round_trip(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        B.encode(frame(spark, []), chunk=10, overlap=3)


def test_some_texts_meet_and_some_do_not(spark):
    """Words meet in the overlap; a run of letters longer than it does not and is scanned whole."""
    scan = B._scan(50, 20)
    rows = [(0, "some words of a text " * 20), (1, "x" * 500)]
    df = spark.createDataFrame(rows, "key bigint, text string").mapInArrow(
        B._chunks(50, 20), "key bigint, part int, last boolean, text string"
    )
    scanned = df.mapInArrow(
        scan, "key bigint, part int, last boolean, text string, bounds binary, head array<int>, tail array<int>"
    )
    assert {(r.key, r.met) for r in B.stitched(scanned, 50).collect()} == {(0, True), (1, False)}


def test_long_words_and_texts(spark, library):
    rnd = random.Random(2)
    word = "".join(rnd.choice("abcdeè") for _ in range(1_000_000))
    start = time.perf_counter()
    ids = np.frombuffer(B.merge_long(B.ranks(B.RANKS), word.encode()), "<u2").tolist()
    assert time.perf_counter() - start < 60 and ids == library.encode_ordinary(word)
    prose = "".join(rnd.choice(["some ", "words\n", "it's ", "1234 "]) for _ in range(600_000))
    rows = [(0, prose), (1, word), (2, "short")]
    got = B.round_trip(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == expected(library, rows)
