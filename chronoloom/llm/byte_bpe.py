"""Byte-level BPE by a rank file: overlapping chunks, stitched pre-tokens, merges by rank.

A long text is cut into chunks that overlap. Each chunk, a row of its own, is pre-tokenised from its
start, wherever that lies, in parallel. The pattern looks only ahead, so two scans that meet in one
boundary agree from there on: a chunk's pre-tokens count from the first boundary, within the overlap, that the chunk before
has too. Boundaries too near to a chunk's end are not trusted, as the characters
behind it could move them. Only then are the pre-tokens between two stitches encoded. If two scans
do not meet within the overlap (a run of letters longer than it, say), the text is scanned as one.

Merges take the pair of least rank first, the leftmost among equals. Short pre-tokens go through
them in step in numpy and are kept in a bounded cache, long ones have an agenda of their own.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.exchange import written
from chronoloom.llm.text import give_back

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: The longest alternative that a boundary depends on behind itself: two letters after an apostrophe.
MARGIN = 3
CACHE = 200_000
SHORT = 48
_NONE = np.iinfo(np.int64).max
#: Python counts four control characters as white space that Unicode does not.
_SPLIT = regex.compile(PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _byte_of() -> dict[str, int]:
    """Byte that each character of a byte-level vocabulary stands for."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(other)}


def read_ids(path: str) -> dict[bytes, int]:
    """Ids of a rank file, or of a byte-level JSON vocabulary whose ids follow its merges."""
    if not path.endswith(".json"):
        with open(path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte, vocab = _byte_of(), model["vocab"]
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    ids = [vocab[m] for m in merges]
    if ids != sorted(ids):
        raise ValueError(f"the ids of {path} do not follow its merges")
    known = {c for c in byte} | set(merges)
    return {bytes(byte[c] for c in token): i for token, i in vocab.items() if token in known}


class Ranks:
    """Byte strings with their ids, which are their merge ranks too."""

    def __init__(self, path: str):
        self.ids = read_ids(path)
        self.n = max(self.ids.values()) + 1
        self.bytes = [b""] * self.n
        for token, i in self.ids.items():
            self.bytes[i] = token
        self.byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.names = [b"%d" % i for i in range(self.n)]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.width = "<u2" if self.n <= 1 << 16 else "<i4"
        rows = [
            (self.ids[token[:k]] * self.n + self.ids[token[k:]], i)
            for token, i in self.ids.items()
            for k in range(1, len(token))
            if token[:k] in self.ids and token[k:] in self.ids
        ]
        pairs = np.array(sorted(rows), np.int64).reshape(-1, 2)
        self.pair, self.whole = pairs[:, 0].copy(), pairs[:, 1].copy()

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id that two neighbours merge into, or `_NONE`."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.whole[at], _NONE)


@functools.lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


def merge_short(v: Ranks, words: list[bytes]) -> list[bytes]:
    """Packed ids of words that are not empty; one merge a word and round."""
    ids = v.byte[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(ids):
        into = np.full(len(ids), _NONE)
        inner = np.flatnonzero(word[1:] == word[:-1])
        into[inner] = v.merged(ids[inner], ids[inner + 1])
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        sizes = np.diff(np.append(starts, len(ids)))
        least = np.repeat(np.minimum.reduceat(into, starts), sizes)
        stop = least == _NONE
        done.append((word[stop], ids[stop]))
        hits = np.flatnonzero((into == least) & ~stop)
        at = hits[np.concatenate(([True], word[hits][1:] != word[hits][:-1]))] if len(hits) else hits
        ids[at] = into[at]
        stop[at + 1] = True
        ids, word = ids[~stop], word[~stop]
    word, ids = (np.concatenate(x) for x in zip(*done))
    raw = ids[np.argsort(word, kind="stable")].astype(v.width).tobytes()
    ends = np.cumsum(np.bincount(word, minlength=len(words))) * np.dtype(v.width).itemsize
    return [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


def merge_long(v: Ranks, word: bytes) -> bytes:
    """Packed ids of one word of any length, by an agenda of spans to merge."""
    n, find = len(word), v.ids.get
    end = list(range(1, n + 1)) + [0]  # of the part that starts here, 0 if none does
    before = list(range(-1, n))
    agenda = []
    for i in range(n - 1):
        rank = find(word[i : i + 2])
        if rank is not None:
            agenda.append((rank, i, i + 2))
    heapq.heapify(agenda)
    while agenda:
        _, a, c = heapq.heappop(agenda)
        b = end[a]
        if not b or b >= n or end[b] != c:
            continue
        end[a], end[b], before[c] = c, 0, a
        if c < n:
            rank = find(word[a : end[c]])
            if rank is not None:
                heapq.heappush(agenda, (rank, a, end[c]))
        p = before[a]
        if p >= 0:
            rank = find(word[p:c])
            if rank is not None:
                heapq.heappush(agenda, (rank, p, c))
    out, a = [], 0
    while a < n:
        out.append(v.ids[word[a : end[a]]])
        a = end[a]
    return np.array(out, v.width).tobytes()


class Encoder:
    """Packed ids of pre-tokens; those of short ones met before come from a cache."""

    def __init__(self, path: str):
        self.v = ranks(path)
        self.cache: dict[str, bytes] = {}

    def words(self, words: list[str]) -> list[bytes]:
        new = set(words).difference(self.cache)
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = set(words)
        other: dict[str, bytes] = {}
        short = []
        for w in new:
            raw = w.encode()
            known = self.v.ids.get(raw)
            if known is not None:
                self.cache[w] = known.to_bytes(np.dtype(self.v.width).itemsize, "little")
            elif len(raw) <= SHORT:
                short.append((w, raw))
            else:
                other[w] = merge_long(self.v, raw)
        for a in range(0, len(short), 10_000):
            names, raws = zip(*short[a : a + 10_000])
            self.cache.update(zip(names, merge_short(self.v, list(raws))))
        if other:
            return [other[w] if w in other else self.cache[w] for w in words]
        return list(map(self.cache.__getitem__, words))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, none for null."""
        split = [_SPLIT.findall(t) if t else [] for t in texts]
        coded = self.words([w for ws in split for w in ws])
        out, a = [], 0
        for ws in split:
            out.append(np.frombuffer(b"".join(coded[a : a + len(ws)]), self.v.width))
            a += len(ws)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def decode_ids(v: Ranks, ids: np.ndarray) -> bytes:
    """The raw bytes of the tokens, one after the other."""
    return b"".join(map(v.bytes.__getitem__, ids.tolist()))


def parts(batch: pa.RecordBatch, column: int, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of bounded text length; a longer text comes alone."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    a = 0
    while a < len(sizes):
        b, size = a, 0
        while b < len(sizes) and (b == a or size + sizes[b] <= most):
            size += sizes[b]
            b += 1
        yield batch.slice(a, b - a)
        a = b


def lists(ids: list[np.ndarray | None]) -> pa.Array:
    offs = np.concatenate(([0], np.cumsum([0 if x is None else len(x) for x in ids])))
    flat = np.concatenate([x for x in ids if x is not None] or [np.zeros(0)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat), mask=pa.array([x is None for x in ids]))


def digests(v: Ranks, ids: list[np.ndarray | None]) -> list[pa.Array]:
    """Number of tokens, hash of their decimal ids, hash of the decoded bytes."""
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = [np.zeros(0, v.width) if x is None else x for x in ids]
    return [
        pa.array([len(x) for x in ids], pa.int64()),
        pa.array([sha(b",".join(map(v.names.__getitem__, x.tolist()))) for x in ids], pa.string()),
        pa.array([sha(decode_ids(v, x)) for x in ids], pa.string()),
    ]


DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _whole(path: str, digest: bool):
    """Texts (column 0) to tokens, beside their rows (column 1)."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for part in parts(batch, 0):
                texts = part.column(0).to_pylist()
                ids = [None if t is None else x for t, x in zip(texts, e.encode(texts))]
                made = digests(e.v, ids) if digest else [lists(ids)]
                names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["tokens"]
                yield pa.RecordBatch.from_arrays([*made, part.column(1)], names=[*names, "row"])
        give_back()

    return fn


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds a key to each row; written once, so it is the same for all that follows."""
    at = TaskContext.get().partitionId() << 33
    for batch in batches:
        yield batch.append_column("key", pa.array(np.arange(at, at + batch.num_rows), pa.int64()))
        at += batch.num_rows


def _chunks(chunk: int, overlap: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = -(-len(text) // chunk)
                for a in range(0, n, 64):
                    span = range(a, min(n, a + 64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(span), pa.int64()),
                            pa.array(span, pa.int32()),
                            pa.array([i == n - 1 for i in span], pa.bool_()),
                            pa.array([text[i * chunk : (i + 1) * chunk + overlap] for i in span], pa.string()),
                        ],
                        names=["key", "part", "last", "text"],
                    )

    return fn


def boundaries(text: str, whole_end: bool) -> np.ndarray:
    """Starts of the pre-tokens and the end, as far as what follows the text cannot change them."""
    at = np.concatenate(([0], np.cumsum([len(w) for w in _SPLIT.findall(text)]))).astype(np.int32)
    return at if whole_end else at[at <= len(text) - MARGIN]


def _scan(chunk: int, overlap: int):
    """Boundaries of each chunk; `head` and `tail` are those in the overlaps with its neighbours."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, heads, tails = [], [], []
            for last, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                at = boundaries(text, last)
                bounds.append(at.tobytes())
                heads.append(at[at <= overlap])
                tails.append(at[at >= chunk] - chunk)
            cols = [*batch.columns, pa.array(bounds, pa.binary()), lists(heads), lists(tails)]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "part", "last", "text", "bounds", "head", "tail"])

    return fn


def _encode_between(path: str):
    """Ids of the pre-tokens between two stitches; from rows (key, part, text, bounds, low, high)."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            out = []
            for text, bounds, low, high in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5))):
                at = np.frombuffer(bounds, np.int32)
                at = at[(at >= low) & (at <= high)].tolist()
                words = e.words([text[a:b] for a, b in zip(at, at[1:])])
                out.append(np.frombuffer(b"".join(words), e.v.width))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], lists(out)], names=["key", "part", "ids"])

    return fn


def _gather(path: str, digest: bool):
    """Digests or lists from (tokens, row)."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = ranks(path)
        for batch in batches:
            ids = [np.array(x, v.width) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*digests(v, ids), batch.column(1)], names=["n_tokens", "ids_sha256", "decoded_sha256", "row"]
            )

    return fn


def stitched(chunks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(key, part, low, high, met): boundaries that a chunk's pre-tokens lie between.

    `met` says whether all scans of the text's chunks met; a text has as many rows here as chunks.
    """
    order = Window.partitionBy("key").orderBy("part")
    meet = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    rows = chunks.select("key", "part", "last", meet.alias("meet"))
    low = F.coalesce(F.lag("meet").over(order), F.lit(0))
    high = F.when(F.col("last"), F.lit(2**31 - 1)).otherwise(F.col("meet") + F.lit(chunk))
    met = F.min(F.col("last") | F.col("meet").isNotNull()).over(Window.partitionBy("key"))
    return rows.select("key", "part", low.alias("low"), high.alias("high"), met.alias("met"))


def _encoded(docs: DataFrame, text_col: str, path: str, chunk: int, overlap: int, digest: bool) -> DataFrame:
    """Rows (tokens or digests, row) of all documents."""
    packed = docs.select(F.col(text_col).alias("text"), F.struct(*map(F.col, docs.columns)).alias("row"))
    made = DIGEST if digest else "tokens array<int>"
    schema = f"{made}, row " + packed.schema["row"].dataType.simpleString()
    long = F.coalesce(F.length("text") > chunk, F.lit(False))
    whole = packed.filter(~long).mapInArrow(_whole(path, digest), schema)
    numbered = written(
        packed.filter(long).mapInArrow(
            _number, "text string, row " + packed.schema["row"].dataType.simpleString() + ", key bigint"
        ),
        "long",
    )
    if numbered.isEmpty():
        return whole
    chunked = numbered.select("key", "text").mapInArrow(
        _chunks(chunk, overlap), "key bigint, part int, last boolean, text string"
    )
    scanned = written(
        chunked.repartition("key", "part").mapInArrow(
            _scan(chunk, overlap),
            "key bigint, part int, last boolean, text string, bounds binary, head array<int>, tail array<int>",
        ),
        "chunks",
    )
    stitches = written(stitched(scanned, chunk), "stitches")
    spans = scanned.join(stitches.filter("met"), ["key", "part"]).select("key", "part", "text", "bounds", "low", "high")
    ids = spans.mapInArrow(_encode_between(path), "key bigint, part int, ids array<int>")
    tokens = ids.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    tokens = tokens.select("key", F.flatten(F.col("parts.ids")).alias("tokens"))
    joined = numbered.join(tokens, "key").select("tokens", "row")
    result = whole.union(joined.mapInArrow(_gather(path, digest), schema) if digest else joined.select("tokens", "row"))
    apart = stitches.filter(~F.col("met")).select("key").distinct()
    alone = numbered.join(apart, "key").select("text", "row").mapInArrow(_whole(path, digest), schema)
    return result.union(alone)


def encode(
    docs: DataFrame,
    text_col: str = "text",
    path: str = RANKS,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The documents with `tokens`, the token ids of their texts as array<int>.

    A null text has null tokens, an empty one none; equal rows are encoded each. Texts of more than
    `chunk` characters are cut into chunks. A column called `tokens` is replaced, all others are
    kept, whatever their names. An empty table gives no rows. The rank file must be at the same
    path on every machine.
    """
    if not MARGIN < overlap <= chunk:
        raise ValueError("the overlap must be over 3 and no more than the chunk")
    if text_col not in docs.columns:
        raise ValueError(f"no column {text_col}")
    rows = _encoded(docs, text_col, path, chunk, overlap, False)
    return rows.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != "tokens"), "tokens")


def _decode(path: str):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = ranks(path)
        for batch in batches:
            raw = [None if x is None else b"".join(map(v.bytes.__getitem__, x)) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), batch.column(1)], names=["decoded", "row"])

    return fn


def decode(coded: DataFrame, tokens_col: str = "tokens", path: str = RANKS) -> DataFrame:
    """The rows with `decoded`, the bytes that the ids of `tokens_col` stand for; null for null."""
    rows = coded.select(F.col(tokens_col).alias("ids"), F.struct(*map(F.col, coded.columns)).alias("row"))
    made = rows.mapInArrow(_decode(path), "decoded binary, row " + rows.schema["row"].dataType.simpleString())
    return made.select(*(F.col("row")[c].alias(c) for c in coded.columns if c != "decoded"), "decoded")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document; null texts count as empty."""
    rows = _encoded(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", path, chunk, overlap, True)
    return rows.select(F.col("row.id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
