"""Merge-dropout against a plain agenda, and long words."""

import random
import time

import numpy as np

from chronoloom.llm import pieces
from chronoloom.llm.text import U, mix


def plain(v, word, key, dropout):
    """Candidates one by one: the best of all that have not been skipped, again and again."""
    parts = [(i, i + 1, v.char.get(c, -1)) for i, c in enumerate(word)]
    table = dict(zip(v.pair.tolist(), v.whole.tolist()))

    def skips(a, b, c):
        code = (a * pieces._PLACE + (b - a) * pieces._LEFT + c - b) % 2**64
        return mix(np.array([(key + code) % 2**64], U)).astype(float)[0] < dropout * 2.0**64

    while True:
        best = None
        for k, ((a, b, x), (_, c, y)) in enumerate(zip(parts, parts[1:])):
            new = table.get(x * v.n + y, -1) if x >= 0 and y >= 0 else -1
            if new >= 0 and not skips(a, b, c):
                best = min(best or (v.rank[new], a, k, new, c), (v.rank[new], a, k, new, c))
        if best is None:
            break
        _, a, k, new, c = best
        parts[k : k + 2] = [(a, c, new)]
    out = []
    for a, _, x in parts:
        out += [x] if x >= 0 else v.byte[list(word[a].replace(pieces._LITERAL, pieces.SPACE).encode())].tolist()
    return out


def words():
    rnd = random.Random(6)
    out = ["▁unbelievable", "▁", "\n", "▁naïve日本🙂", "▁▁▁", "a" * 150, "▁" + "theand" * 40]
    return out + ["▁" + "".join(rnd.choice("abcdeilnorst日é") for _ in range(rnd.randint(1, 30))) for _ in range(200)]


def test_all_ways_agree():
    v, ws = pieces.vocabulary(pieces.MODEL), words()
    for dropout in (0.0, 0.1, 0.5):
        encoder = pieces.Encoder(pieces.MODEL, 1, dropout)
        keys = np.arange(1, len(ws) + 1).astype(U) * U(0x9E3779B97F4A7C15)
        got = encoder._part(ws, keys)
        for w, k, g, h in zip(ws, keys.tolist(), got, pieces.encode_words(v, ws, keys, dropout)):
            want = plain(v, w, k, dropout)
            assert np.frombuffer(g, encoder.width).tolist() == want == np.frombuffer(h, encoder.width).tolist()
            assert np.frombuffer(pieces.encode_long(v, w, k, dropout), encoder.width).tolist() == want


def test_small_cache(monkeypatch):
    texts = [" ".join(w.strip("▁\n") for w in words())] * 2
    names = ["1", "2"]
    want = [g.tolist() for g in pieces.Encoder(pieces.MODEL, 3, 0.2).encode(texts, names)]
    monkeypatch.setattr(pieces, "CACHE", 5)
    assert [g.tolist() for g in pieces.Encoder(pieces.MODEL, 3, 0.2).encode(texts, names)] == want


def test_text_without_spaces():
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcdeilnorst日é本") for _ in range(500_000))
    start = time.perf_counter()
    for dropout in (0.0, 0.1):
        encoder = pieces.Encoder(pieces.MODEL, 1, dropout)
        (ids,) = encoder.encode([text], ["1"])
        assert pieces.decode_ids(encoder.v, ids) == text
    assert time.perf_counter() - start < 60
