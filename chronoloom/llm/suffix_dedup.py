"""Removal of byte strings that occur more than once, by a distributed merge sort of suffixes.

A full suffix array of 100 TB would have a hundred trillion entries, so the array is sparse: of
every `length`-byte window one suffix is kept, the one whose first 8 bytes hash lowest among the
first half of the window. The choice depends on the window's content alone, so two equal windows
keep the same suffix, and every repeated window is seen at one of its kept suffixes.

1. Suffixes whose half-length prefix occurs once in the corpus are dropped (`exchange`).
2. Each bucket sorts the rest into one run and sends it front-coded: the length of the prefix
   shared with the suffix before, and the bytes after it. Runs are dealt by the hash of the
   half-length prefix, so suffixes that can share a window meet.
3. A partition merges its runs with a loser tree. A comparison starts from the prefixes already
   known to be shared and never looks at these bytes again; the merge yields the common prefix
   of neighbours as well.
4. Within neighbours that share d bytes less than a window, equal texts of d bytes to the left
   mean equal windows. The smallest and largest such d give the repeated range around a suffix.

Suffixes with equal bytes on both sides are sent once by a bucket, and a prefix that very many
different places share (`hot`) is not merged but asked for window by window, which spreads over
all partitions; both ways give the same ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.exchange import (
    BUCKET,
    Buckets,
    ask_repeated,
    bucket_map,
    read_answers,
    target_of,
    text_bytes,
)
from chronoloom.llm.text import Texts, U, covered, inverse_powers, mix, powers, window_min

GRAM = 8
CHUNK = 1 << 20
_POSITION = U(CHUNK - 1)
_BASE = 0x9FB21C651E98DF25
_LEFT = U(0x2545F4914F6CDD1D)
RUN, HOT, KNOWN = 0, 1, 2
_MOVED = f"target int, {BUCKET} int, kind int, n int, pack binary"
_RANGES = f"{BUCKET} int, pack binary"


def _grams(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one number."""
    out = np.empty(max(0, len(buf) - GRAM + 1), U)
    for k in range(min(GRAM, len(out))):
        m = (len(buf) - k) // GRAM
        out[k::GRAM] = buf[k : k + m * GRAM].view("<u8")
    return out


def kept_suffixes(buf: np.ndarray, length: int) -> np.ndarray:
    """Start of the suffix kept for each window; ascending."""
    half = length // 2
    width = length - half + 1
    found = []
    step = CHUNK - length
    for a in range(0, max(1, len(buf) - length + 1), step):
        part = buf[a : a + CHUNK]
        if len(part) < length:
            break
        g = mix(_grams(part))
        g = (g & ~_POSITION) | np.arange(len(g), dtype=U)  # the leftmost of equal ones
        low = window_min(g, width)[: len(part) - length + 1]
        at = (low & _POSITION).astype(np.int64)
        found.append(at[np.concatenate(([True], at[1:] != at[:-1]))] + a)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


class _Bucket:
    """A bucket's text, its kept suffixes and the hashes of their half-length prefixes."""

    def __init__(self, table: pa.Table, length: int):
        self.texts = t = Texts(text_bytes(table))
        self.half = length // 2
        p = kept_suffixes(t.buf, length)
        doc = np.searchsorted(t.offs, p, "right") - 1
        self.ends = t.offs[doc + 1] - 1
        self.begins = t.offs[doc]
        fits = p + self.half <= self.ends
        self.p, self.begins, self.ends = p[fits], self.begins[fits], self.ends[fits]
        self.sums = None
        self.keys = self.hashes(self.p, self.p + self.half)

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.sums is None:
            n = len(self.texts.buf)
            self.sums = np.zeros(n + 1, U)
            np.cumsum((self.texts.buf + U(1)) * powers(_BASE, n), out=self.sums[1:])
        return mix((self.sums[b] - self.sums[a]) * inverse_powers(_BASE, a))


def _shared(rows: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the one before; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differs = rows[1:] != rows[:-1]
        first = differs.argmax(axis=1)
        first[~differs.any(axis=1)] = rows.shape[1]
        out[1:] = np.minimum(first, np.minimum(lens[1:], lens[:-1]))
    return out


def encode_run(suffixes: list[bytes], lefts: list[bytes], at: np.ndarray) -> bytes:
    """Front-coded sorted run; `lefts` are the bytes before each suffix."""
    lens = np.array([len(s) for s in suffixes], np.int64)
    width = int(lens.max())
    flat = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in suffixes), np.uint8).reshape(-1, width)
    shared = _shared(flat, lens)
    rest = b"".join(s[k:] for s, k in zip(suffixes, shared.tolist()))
    head = np.stack([shared, lens, np.array([len(x) for x in lefts]), at]).astype("<i4")
    raw = np.int32(len(suffixes)).tobytes() + head.tobytes() + rest + b"".join(lefts)
    return zstandard.ZstdCompressor(level=1).compress(raw)


class Run:
    """Reads a front-coded run, one suffix at a time."""

    def __init__(self, pack: bytes):
        raw = zstandard.ZstdDecompressor().decompress(pack)
        n = int(np.frombuffer(raw, "<i4", 1)[0])
        shared, lens, left_lens, at = np.frombuffer(raw, "<i4", 4 * n, 4).reshape(4, n)
        self.n, self.lens, self.left_lens, self.at = n, lens, left_lens, at
        self.shared = shared.tolist()
        bounds = np.concatenate(([0], np.cumsum(lens - shared))) + 4 + 16 * n
        self.bounds, self.raw = bounds.tolist(), raw
        self.left_start = int(bounds[-1])
        self.i, self.head = -1, b""

    def advance(self) -> int:
        """Moves to the next suffix; what it shares with the one before, or -1 at the end."""
        self.i += 1
        if self.i == self.n:
            return -1
        k = self.shared[self.i]
        self.head = self.head[:k] + self.raw[self.bounds[self.i] : self.bounds[self.i + 1]]
        return k


def _compare(a: bytes, b: bytes, known: int) -> tuple[bool, int]:
    """(a sorts first, length of the common prefix), looking at bytes from `known` on only."""
    x, y = a[known:], b[known:]
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return len(x) <= len(y), known + n
    d = int.from_bytes(x[:n]) ^ int.from_bytes(y[:n])
    return x < y, known + n - (d.bit_length() + 7) // 8


def merge_runs(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, index in it, prefix shared with the suffix given out before) in sorted order.

    Loser tree: an inner node keeps the run that lost there and the prefix it shares with the
    winner. All prefixes on the winner's way up refer to the suffix given out last, so of two
    contenders the one that shares more with it comes first, and only equal ones are compared.
    """
    size = 1 << max(0, len(runs) - 1).bit_length()
    known = [r.advance() for r in runs] + [-1] * (size - len(runs))
    losers = [(0, -1)] * size

    def play(x: int, kx: int, y: int, ky: int) -> tuple[int, int, int, int]:
        """Winner and loser; a known prefix of -1 means that the run has ended."""
        if kx != ky:
            return (x, kx, y, ky) if kx > ky else (y, ky, x, kx)
        if kx < 0:
            return x, kx, y, ky
        first, common = _compare(runs[x].head, runs[y].head, kx)
        return (x, kx, y, common) if first else (y, ky, x, common)

    def build(node: int) -> tuple[int, int]:
        if node >= size:
            return node - size, known[node - size]
        a, b = build(2 * node), build(2 * node + 1)
        w, kw, lost, kl = play(*a, *b)
        losers[node] = (lost, kl)
        return w, kw

    best, k = build(1) if size > 1 else (0, known[0])
    while k >= 0:
        yield best, runs[best].i, k
        cur, k = best, runs[best].advance()
        node = (cur + size) >> 1
        while node:
            lost, kl = losers[node]
            if kl > k:
                losers[node] = (cur, k)
                cur, k = lost, kl
            elif kl == k >= 0:
                first, common = _compare(runs[cur].head, runs[lost].head, k)
                if first:
                    losers[node] = (lost, common)
                else:
                    losers[node] = (cur, common)
                    cur = lost
            node >>= 1
        best = cur


def _mark_same(keys: np.ndarray) -> np.ndarray:
    by = np.argsort(keys, kind="stable")
    same = keys[by][1:] == keys[by][:-1]
    hit = np.zeros(len(keys), bool)
    hit[by[1:]] |= same
    hit[by[:-1]] |= same
    return hit


def window_range(shared: np.ndarray, lefts: np.ndarray, left_lens: np.ndarray, length: int):
    """Least and largest d at which another suffix has the same window; -1 where none has.

    The window of a suffix at d has the d bytes before it and the first length - d of its own.
    `shared` are the common prefixes of sorted neighbours, lefts[:, d - 1] the d-th byte before.
    """
    least, most = np.full(len(shared), -1, np.int64), np.full(len(shared), -1, np.int64)
    left = np.zeros(len(shared), U)
    for d in range(length - length // 2 + 1):
        if d:
            left = mix((left + lefts[:, d - 1] + U(1)) * _LEFT)
        part = np.cumsum(shared < length - d).astype(U)
        fits = np.flatnonzero(left_lens >= d)
        hit = fits[_mark_same(mix(left[fits] + part[fits] * U(0x9E3779B97F4A7C15)))]
        least[hit] = np.where(least[hit] < 0, d, least[hit])
        most[hit] = d
    return least, most


def _pairs(a, b) -> bytes:
    return np.stack([a, b]).astype("<i4").tobytes()


class _Rows:
    """Rows of `_MOVED` under way to the partitions that merge."""

    def __init__(self, bucket: int):
        self.bucket, self.rows = bucket, []

    def add(self, target: int, kind: int, n: int, pack: bytes) -> None:
        self.rows.append((target, self.bucket, kind, n, pack))

    def table(self) -> pa.Table:
        cols = list(zip(*self.rows)) or [()] * 5
        types = [pa.int32()] * 4 + [pa.binary()]
        return pa.table(
            [pa.array(c, t) for c, t in zip(cols, types)], names=["target", BUCKET, "kind", "n", "pack"]
        )


def _hot_windows(b: _Bucket, p: np.ndarray, begins: np.ndarray, ends: np.ndarray, length: int):
    """All windows that the suffixes p can stand for: their starts and hashes."""
    at = (p[:, None] - np.arange(length - b.half + 1)[None, :]).ravel()
    width = length - b.half + 1
    ok = (at >= np.repeat(begins, width)) & (at + length <= np.repeat(ends, width))
    at = np.unique(at[ok])
    return at, b.hashes(at, at + length)


def _send(length: int, targets: int, answering: int):
    """Sorted runs of a bucket's repeated suffixes, and the ranges that it knows by itself."""

    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        b = _Bucket(table, length)
        out = _Rows(table.column(BUCKET)[0].as_py())
        if not len(b.p):
            return out.table()
        flags = read_answers(b.keys, answers, answering)
        known: list[np.ndarray] = []
        hot = np.flatnonzero(flags[2])
        if len(hot):
            at, keys = _hot_windows(b, b.p[hot], b.begins[hot], b.ends[hot], length)
            known.append(np.stack([at, at + length])[:, _mark_same(keys)])
            keys, first = np.unique(keys, return_index=True)
            to = target_of(keys, targets)
            for t in np.unique(to).tolist():
                mine = to == t
                out.add(t, HOT, int(mine.sum()), keys[mine].tobytes() + at[first[mine]].astype("<i4").tobytes())
        keep = np.flatnonzero(flags[0] & ~flags[2])
        p, keys = b.p[keep], b.keys[keep]
        stop = np.minimum(p + length, b.ends[keep])
        start = np.maximum(p - (length - b.half), b.begins[keep])
        raw = b.texts.buf.tobytes()
        to = target_of(keys, targets).tolist()
        items = sorted(
            (t, raw[m:z], raw[a:m], m) for t, a, m, z in zip(to, start.tolist(), p.tolist(), stop.tolist())
        )
        firsts, i = [], 0
        while i < len(items):
            j = i + 1
            while j < len(items) and items[j][:3] == items[i][:3]:
                j += 1
            _, suffix, left, _ = items[i]
            if j - i > 1 and len(suffix) + len(left) >= length:
                m = np.array([x[3] for x in items[i:j]])
                known.append(np.stack([m - len(left), m + len(suffix)]))
            firsts.append(items[i])
            i = j
        i = 0
        while i < len(firsts):
            j = i + 1
            while j < len(firsts) and firsts[j][0] == firsts[i][0]:
                j += 1
            _, suffixes, lefts, m = zip(*firsts[i:j])
            out.add(firsts[i][0], RUN, j - i, encode_run(suffixes, lefts, np.array(m)))
            i = j
        ranges = np.concatenate(known, axis=1) if known else np.zeros((2, 0), np.int64)
        if ranges.shape[1]:
            out.add(-1 - out.bucket, KNOWN, ranges.shape[1], _pairs(*ranges))
        return out.table()

    return send


def _merged(buckets: list[int], packs: list[bytes], length: int) -> list[tuple[int, bytes]]:
    """Ranges by bucket from the runs of one partition."""
    runs = [Run(p) for p in packs]
    found = list(merge_runs(runs))
    which, index, shared = (np.array(x, np.int64) for x in zip(*found))
    half = length // 2
    near = np.append(shared[1:] >= half, False) | (shared >= half)
    which, index, shared = which[near], index[near], shared[near]
    if not len(which):
        return []
    reach = length - half
    left_ends = [np.cumsum(r.left_lens) + r.left_start for r in runs]
    lens = np.array([runs[w].left_lens[i] for w, i in zip(which, index)], np.int64)
    flat = bytearray()
    for w, i, n in zip(which.tolist(), index.tolist(), lens.tolist()):
        e = int(left_ends[w][i])
        flat += runs[w].raw[e - n : e][::-1].ljust(reach, b"\0")
    lefts = np.frombuffer(bytes(flat), np.uint8).reshape(-1, reach)
    least, most = window_range(shared, lefts, lens, length)
    at = np.array([runs[w].at[i] for w, i in zip(which, index)], np.int64)
    out = []
    for w in np.unique(which[most >= 0]).tolist():
        mine = (which == w) & (most >= 0)
        out.append((buckets[w], _pairs(at[mine] - most[mine], at[mine] - least[mine] + length)))
    return out


def _asked(buckets: list[int], ns: list[int], packs: list[bytes], length: int) -> list[tuple[int, bytes]]:
    """Ranges by bucket from window hashes of one partition."""
    keys = np.concatenate([np.frombuffer(p, U, n) for n, p in zip(ns, packs)])
    at = np.concatenate([np.frombuffer(p, "<i4", n, 8 * n) for n, p in zip(ns, packs)]).astype(np.int64)
    whose = np.repeat(np.arange(len(ns)), ns)
    hit = _mark_same(keys)
    return [
        (buckets[w], _pairs(at[hit & (whose == w)], at[hit & (whose == w)] + length))
        for w in np.unique(whose[hit]).tolist()
    ]


def _merge(length: int):
    def merge(table: pa.Table) -> pa.Table:
        by_kind: dict[int, list] = {RUN: [], HOT: [], KNOWN: []}
        cols = [table.column(c).to_pylist() for c in (BUCKET, "kind", "n", "pack")]
        for bucket, kind, n, pack in zip(*cols):
            by_kind[kind].append((bucket, n, pack))
        out = [(b, pack) for b, _, pack in by_kind[KNOWN]]
        if by_kind[RUN]:
            b, _, packs = zip(*by_kind[RUN])
            out += _merged(b, packs, length)
        if by_kind[HOT]:
            out += _asked(*zip(*by_kind[HOT]), length)
        return pa.table(
            {BUCKET: pa.array([b for b, _ in out], pa.int32()), "pack": pa.array([p for _, p in out], pa.binary())}
        )

    return merge


def repeated_ranges(buckets: Buckets, length: int = 200, hot: int = 50_000) -> DataFrame:
    """Byte ranges of each bucket's buffer that repeated windows cover; they may overlap."""
    if length < 4 * GRAM:
        raise ValueError(f"length must be at least {4 * GRAM}")
    half = length // 2
    answers, answering = ask_repeated(buckets, lambda t: _Bucket(t, length).keys, half / 2, hot)
    targets = max(1, math.ceil(buckets.total / half * 2 / 100_000))
    moved = bucket_map(buckets, answers, _send(length, targets, answering), _MOVED)
    return moved.groupBy("target").applyInArrow(_merge(length), _RANGES)


def _apply(table: pa.Table, ranges: pa.Table) -> pa.Table:
    t = Texts(text_bytes(table))
    packs = [np.frombuffer(p, "<i4").reshape(2, -1) for p in ranges.column("pack").to_pylist()]
    a, b = np.concatenate([*packs, np.zeros((2, 0), np.int32)], axis=1)
    gone = covered(len(t.buf), a, b)
    raw, kept, removed, spans = t.buf.tobytes(), [], [], []
    for x, y in zip(t.offs[:-1].tolist(), (t.offs[1:] - 1).tolist()):
        g = gone[x:y]
        n = int(np.count_nonzero(g))
        removed.append(n)
        spans.append(int(np.count_nonzero(g[1:] & ~g[:-1])) + int(g[0]) if n else 0)
        kept.append(t.buf[x:y][~g].tobytes() if n else raw[x:y])
    return pa.table(
        {
            "doc_id": table.column("id"),
            "n_bytes": pa.array(np.diff(t.offs) - 1, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def dedup_suffixes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, hot: int = 50_000
) -> DataFrame:
    """Per document the UTF-8 bytes without those that a repeated `length`-byte string covers.

    Every occurrence is removed, the first too; matches never cross documents, and strings are
    judged on the input. `kept` is binary, as a cut can fall inside a character. A null text
    counts as empty, a row with a null or repeated id as a document of its own; a table without
    rows gives none. Other columns are ignored. `hot` only chooses the way by which a prefix
    that more places share is looked up, not the result.
    """
    buckets = Buckets(docs, id_col, text_col)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = schema.replace("doc_id bigint", f"doc_id {id_type}")
    return bucket_map(buckets, repeated_ranges(buckets, length, hot), _apply, schema)


def digest(kept: DataFrame) -> DataFrame:
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
