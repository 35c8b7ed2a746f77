"""Alignment of two tokenizers against the libraries and plain loops."""

import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chronoloom.llm import byte_bpe, token_align as T
from tests.llm import plain

SCHEMA = "doc_id bigint, text string, key string, a int, pair int, n string"


def texts():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeéñß") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    words += ["the", "and", "unbelievable", "日本", "🙂", "12345", "...", "it's", "<s>", "<|endoftext|>", "\t", "\n\n", " "]
    out = [None, "", " ", "\n", "a", "▁ literal", "<unk> </s>", "a\x00b", "ｆ full width é", "x" * 500, "  two  "]
    out += [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 120))) for _ in range(30)]
    return out + out[-3:]


def want(rows):
    first, second = Tokenizer.from_file(T.BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=T.PIECES)
    first.encode_special_tokens = True
    byte = byte_bpe._byte_of()
    docs = []
    for i, t in rows:
        a, b, links, groups = [], [], [], ""
        if t:
            a = first.encode(" " + t, add_special_tokens=False).ids
            b = second.encode(t)
            raw_a = [bytes(byte[c] for c in first.id_to_token(x)) for x in a]
            raw_b = [bytes([x - 3]) if second.is_byte(x) else second.id_to_piece(x).replace("▁", " ").encode() for x in b]
            if b"".join(raw_a) != (" " + t).encode() or b"".join(raw_b) != (" " + t).encode():
                a, b = [], []
        if a:
            spans = []
            for raw in (raw_a, raw_b):
                ends = np.cumsum([len(x) for x in raw]).tolist()
                spans.append(list(zip([0, *ends], ends)))
            links = [(a[x], b[y]) for x, (s, e) in enumerate(spans[0]) for y, (u, v) in enumerate(spans[1]) if s < v and u < e]
            both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
            parts = [[",".join(str(x) for x, (s, e) in zip(ids, sp) if u < e <= v) for ids, sp in zip((a, b), spans)] for u, v in zip([0, *both], both)]
            groups = ";".join("|".join(p) for p in parts)
        docs.append((i, a, b, links, groups))
    count = Counter(p for d in docs for p in set(d[3]))
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    rows = [
        (i, len(a), len(b), len(g.split(";")) if g else 0, len(ls), sum(count[p] == most[p[0]] for p in ls), sum(count[p] for p in ls), plain.sha(g) if g else "")
        for i, a, b, ls, g in docs
    ]
    return rows, count, most, docs


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, 2, "n") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return list(enumerate(texts())) + [(3, "again it's"), (None, "no id é")]


@pytest.mark.parametrize("limit", [T.LIMIT, 400])
def test_digest(spark, rows, limit):
    got = sorted(map(tuple, T.digest(frame(spark, rows), limit=limit).collect()), key=str)
    assert got == sorted(want(rows)[0], key=str)
    assert sum(r[1] == 0 for r in got) >= 3


def test_pairs_and_spans(spark, rows, monkeypatch):
    monkeypatch.setattr(T, "HELD", 50)
    _, count, most, docs = want(rows)
    got = T.pair_counts(frame(spark, rows)).collect()
    assert {(r.a, r.b): (r.n, r.best) for r in got} == {p: (n, n == most[p[0]]) for p, n in count.items()}
    spans = sorted(T.align(frame(spark, rows)).collect(), key=lambda r: (str(r.doc_id), r.a))
    for r, (_, a, b, links, groups) in zip(spans, sorted(docs, key=lambda d: (str(d[0]), d[1]))):
        assert (r.a, r.b) == (a, b)
        assert [(x, b[k]) for x, low, high in zip(a, r.low, r.high) for k in range(low, high)] == links
        cut = lambda ids, ends: [",".join(map(str, ids[s:e])) for s, e in zip([0, *ends], ends)]
        assert ";".join("|".join(p) for p in zip(cut(a, r.group_ends_a), cut(b, r.group_ends_b))) == groups


def test_gallop():
    rnd = np.random.default_rng(1)
    for n, m in ((0, 5), (5, 0), (1, 1), (63, 900), (700, 20), (5000, 5000), (3, 100_000)):
        a, b = (np.sort(rnd.choice(200_000, k, replace=False)) for k in (n, m))
        assert T.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def test_empty_table_and_long_text(spark):
    assert T.digest(frame(spark, [])).count() == T.align(frame(spark, [])).count() == T.pair_counts(frame(spark, [])).count() == 0
    rnd = random.Random(1)
    rows = [(1, " ".join(rnd.choice(["some", "words", "of", "été"]) for _ in range(400_000))), (2, "y" * 30_000)]
    got = {r.doc_id: r for r in T.digest(frame(spark, rows)).collect()}
    assert got[1].n_a > 400_000 and got[1].n_groups >= 400_000 and got[1].n_best > 0 and got[2].n_links > 0
