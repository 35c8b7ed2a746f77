"""Alignment of the tokens of two tokenizers, and counts of what they link corpus-wide.

Both tokenizers cut the same bytes, so a text is two ascending lists of byte ends. The shorter
list drives an intersection: from a position that is known to be low enough, each of its ends
gallops through the longer list in doubling steps and then halves the last one. What is in both
closes a group, and the difference between the ranks of two neighbouring ends is the range of
tokens that overlap. The ends of all texts of a batch are looked up together, in numpy: every
4th end first, which gives the ends in between the place to start from.

Ids are written once. One pass counts for each pair of ids the documents that hold it linked,
another looks the counts up. They are broadcast in slices of at most `limit` pairs, a pass each.
"""

from __future__ import annotations

import array
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm import byte_bpe
from chronoloom.llm.exchange import written
from chronoloom.llm.text import give_back

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
STRIDE = 4
#: Pairs in one broadcast: 12 bytes each, so 24 MB in a worker.
LIMIT = 2_000_000
#: Pairs that a task gathers before it hands its counts on.
HELD = 1_000_000
PART = 1_000_000


class Pieces:
    """A SentencePiece model and the bytes of its pieces."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n = self.model.get_piece_size()
        self.bytes = []
        for i in range(self.n):
            name = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(name[1:-1], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode())
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class ByteTokens:
    """A byte-level vocabulary whose ids follow its merges, and the bytes of its tokens."""

    def __init__(self, path: str):
        ids = byte_bpe.read_ids(path)
        self.n = max(ids.values()) + 1
        self.bytes = [b""] * self.n
        for token, i in ids.items():
            self.bytes[i] = token
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.model = tiktoken.Encoding(path, pat_str=byte_bpe.PATTERN, mergeable_ranks=ids, special_tokens={})


@functools.lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


def packed(ids: list[int], n: int) -> bytes:
    return array.array("H" if n <= 1 << 16 else "I", ids).tobytes()


# ---- alignment ----


def gallop(driver: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many of `other` are less than each of `driver`; both ascend."""
    n, m = len(driver), len(other)
    if n <= STRIDE:
        low = np.zeros(n, np.int64)
    else:
        low = np.repeat(gallop(driver[::STRIDE], other), STRIDE)[:n]
    if not m:
        return low
    step, live = 1, np.arange(n)  # everything before `low` is less
    high = np.full(n, m, np.int64)
    while len(live):
        probe = low[live] + step - 1
        inside = probe < m
        less = inside & (other[np.minimum(probe, m - 1)] < driver[live])
        stop = live[inside & ~less]
        high[stop] = low[stop] + step - 1
        live = live[less]
        low[live] += step
        step *= 2
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) >> 1
        less = other[middle] < driver[live]
        low[live[less]] = middle[less] + 1
        high[live[~less]] = middle[~less]
        live = live[low[live] < high[live]]
    return low


class Aligned:
    """Groups and links of texts that follow each other; the first tokens' ends drive."""

    def __init__(self, ends: np.ndarray, others: np.ndarray):
        rank = gallop(ends, others)
        m = len(others)
        same = (rank < m) & (others[np.minimum(rank, m - 1)] == ends) if m else np.zeros(len(ends), bool)
        closes = np.zeros(m, bool)
        closes[rank[same]] = True
        self.group = np.cumsum(same) - same  # of each driving token
        self.other_group = np.cumsum(closes) - closes
        first = np.concatenate(([0], rank + same))[:-1]
        count = rank - first + 1
        self.token = np.repeat(np.arange(len(ends)), count)
        self.other = np.arange(len(self.token)) - np.repeat(np.cumsum(count) - count - first, count)


class Batch:
    """Tokens of some texts by both tokenizers, in one list each, with groups and links.

    Texts whose first list is the shorter one come first, since the shorter one drives; `order`
    has their numbers.
    """

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], sizes_a: np.ndarray, sizes_b: np.ndarray):
        n_a, n_b = (np.array([len(x) for x in s], np.int64) for s in (a, b))
        turned = n_a > n_b
        self.order = np.argsort(turned, kind="stable")
        self.n_a, self.n_b = n_a[self.order], n_b[self.order]
        none = np.zeros(0, np.int64)
        self.a = np.concatenate([none, *(a[i] for i in self.order)]).astype(np.int64)
        self.b = np.concatenate([none, *(b[i] for i in self.order)]).astype(np.int64)
        ends_a, ends_b = np.cumsum(sizes_a[self.a]), np.cumsum(sizes_b[self.b])
        straight = len(turned) - int(turned.sum())
        cut_a, cut_b = int(self.n_a[:straight].sum()), int(self.n_b[:straight].sum())
        x = Aligned(ends_a[:cut_a], ends_b[:cut_b])
        y = Aligned(ends_b[cut_b:], ends_a[cut_a:])
        more = 1 + int(x.group.max(initial=-1))
        self.group_a = np.concatenate((x.group, y.other_group + more))
        self.group_b = np.concatenate((x.other_group, y.group + more))
        self.link_a = np.concatenate((x.token, y.other + cut_a))
        self.link_b = np.concatenate((x.other, y.token + cut_b))
        self.doc_a = np.repeat(np.arange(len(a)), self.n_a)
        self.link_doc = self.doc_a[self.link_a]
        self.pair = self.a[self.link_a] * len(sizes_b) + self.b[self.link_b]

    def groups(self) -> np.ndarray:
        """Number of groups of each text."""
        opens = np.diff(self.group_a, prepend=-1) > 0
        return np.bincount(self.doc_a[opens], minlength=len(self.n_a))

    def distinct_pairs(self) -> np.ndarray:
        """Each pair once for every text that has it."""
        return np.unique((self.link_doc << 34) | self.pair) & ((1 << 34) - 1)

    def in_groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of both lists' tokens if groups follow each other, and which tokens open their group."""
        n = 1 + int(self.group_a.max(initial=-1))
        count_a, count_b = (np.bincount(g, minlength=n) for g in (self.group_a, self.group_b))
        place_a = np.arange(len(self.a)) + (np.cumsum(count_b) - count_b)[self.group_a]
        place_b = np.arange(len(self.b)) + np.cumsum(count_a)[self.group_b]
        return place_a, place_b, np.diff(self.group_a, prepend=-1) > 0, np.diff(self.group_b, prepend=-1) > 0


@functools.lru_cache(maxsize=1)
def _names(n_a: int, n_b: int) -> list[bytes]:
    """Decimal ids behind each separator they may have: `;` `,` and none for the first, `|` `,` for the second list."""
    first = [b"%s%d" % (s, i) for s in (b";", b",", b"") for i in range(n_a)]
    return first + [b"%s%d" % (s, i) for s in (b"|", b",") for i in range(n_b)]


def group_hashes(x: Batch, n_a: int, n_b: int) -> list[str]:
    """Hash of the groups of each text, in the order of the batch; empty without tokens."""
    names = _names(n_a, n_b)
    place_a, place_b, opens_a, opens_b = x.in_groups()
    starts = np.cumsum(x.n_a) - x.n_a
    kind = np.where(opens_a, 0, 1)
    kind[starts[x.n_a > 0]] = 2
    code = np.empty(len(x.a) + len(x.b), np.int64)
    code[place_a] = x.a + kind * n_a
    code[place_b] = x.b + np.where(opens_b, 0, 1) * n_b + 3 * n_a
    out = []
    for a, b in zip((starts + np.cumsum(x.n_b) - x.n_b).tolist(), np.cumsum(x.n_a + x.n_b).tolist()):
        text = b"".join(map(names.__getitem__, code[a:b].tolist()))
        out.append(hashlib.sha256(text).hexdigest() if b > a else "")
    return out


# ---- tokens ----


def _tokenise(first: str, second: str):
    """Ids of each text (column 0) as bytes, empty if the tokens do not spell it, beside its row (column 1)."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = byte_tokens(first), pieces(second)
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in byte_bpe.parts(batch, 0, PART):
                texts = part.column(0).to_pylist()
                packed_a, packed_b = [], []
                for t, y in zip(texts, two.model.encode([t or "" for t in texts], num_threads=1)):
                    raw = " " + t if t else ""
                    x = one.model.encode_ordinary(raw)
                    same = map(one.bytes.__getitem__, x), map(two.bytes.__getitem__, y)
                    fits = all(b"".join(tokens) == raw.encode() for tokens in same)
                    packed_a.append(packed(x, one.n) if fits else b"")
                    packed_b.append(packed(y, two.n) if fits else b"")
                keys = pa.array(np.arange(key, key + len(texts)), pa.int64())
                key += len(texts)
                cols = [keys, pa.array(packed_a, pa.binary()), pa.array(packed_b, pa.binary()), part.column(1)]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "a", "b", "id"])
        give_back()

    return fn


def tokenised(docs: DataFrame, id_col: str, text_col: str, first: str, second: str) -> DataFrame:
    """Written rows (key, a, b, id); `key` tells rows apart whatever their ids are."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    return written(rows.mapInArrow(_tokenise(first, second), f"key bigint, a binary, b binary, id {kind}"), "tokens")


def _batches(batches: Iterator[pa.RecordBatch], first: str, second: str):
    """(rows, Batch) of bounded size, longer texts alone."""
    sides = byte_tokens(first), pieces(second)
    widths = [np.uint16 if v.n <= 1 << 16 else np.uint32 for v in sides]
    for batch in batches:
        for part in byte_bpe.parts(batch, 1, PART // 2):
            a, b = ([np.frombuffer(x, w) for x in part.column(i).to_pylist()] for i, w in zip((1, 2), widths))
            yield part, Batch(a, b, *(v.sizes for v in sides))


def _count(first: str, second: str):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, size = [], [], 0

        def merged():
            keys, at = np.unique(np.concatenate(held), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64)

        for _, x in _batches(batches, first, second):
            keys, n = np.unique(x.distinct_pairs(), return_counts=True)
            held.append(keys)
            counts.append(n)
            size += len(keys)
            if size > 2 * HELD:
                keys, n = merged()
                if len(keys) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])
                    held, counts, size = [], [], 0
                else:
                    held, counts, size = [keys], [n], len(keys)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["pair", "n"])
        give_back()

    return fn


def counted(tokens: DataFrame, first: str, second: str) -> DataFrame:
    """Written rows (pair, n, best): documents that hold a pair linked, and whether its first id has no better one."""
    n_b = pieces(second).n
    counts = tokens.mapInArrow(_count(first, second), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = written(counts.withColumn("a", F.expr(f"pair div {n_b}")), "pairs")
    # No more rows than the first vocabulary has ids.
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _look_up(first: str, second: str, slice_, whole: bool):
    """Sums over the links whose pair is in the slice; with `whole` all else that the digest has, too."""

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = (np.frombuffer(x, np.int64) for x in slice_.value)
        n_a, n_b = byte_tokens(first).n, pieces(second).n
        for part, x in _batches(batches, first, second):
            docs = len(x.order)
            bits = docs.bit_length()
            if bits > 30:
                raise ValueError("too many texts in a batch")
            links = np.sort((x.pair << bits) | x.link_doc)  # by pair, so that each is looked up once
            doc, pair = links & ((1 << bits) - 1), links >> bits
            fresh = np.flatnonzero(np.diff(pair, prepend=-1))
            value = np.zeros(len(fresh), np.int64)
            if len(keys):
                found = np.minimum(np.searchsorted(keys, pair[fresh]), len(keys) - 1)
                value = np.where(keys[found] == pair[fresh], n[found], 0)
            value = np.repeat(value, np.diff(np.append(fresh, len(pair))))
            sums = np.zeros((2, docs), np.int64)
            np.add.at(sums[0], doc, value & 1)
            np.add.at(sums[1], doc, value >> 1)
            cols = [sums[0], sums[1]]
            if whole:
                cols += [x.n_a, x.n_b, x.groups(), np.bincount(x.link_doc, minlength=docs)]
            back = np.argsort(x.order)
            made = [pa.array(np.asarray(c, np.int64)[back]) for c in cols]
            names = ["n_best", "count_sum", "n_a", "n_b", "n_groups", "n_links"][: len(cols)]
            if whole:
                hashes = group_hashes(x, n_a, n_b)
                made += [pa.array([hashes[i] for i in back], pa.string()), part.column(3)]
                names += ["groups_sha256", "doc_id"]
            yield pa.RecordBatch.from_arrays([part.column(0), *made], names=["key", *names])
        give_back()

    return fn


def digest(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first: str = BYTE_LEVEL,
    second: str = PIECES,
    limit: int = LIMIT,
) -> DataFrame:
    """Per document the sizes of its alignment and how common its links are in the corpus.

    A space is put ahead of the text, as the second tokenizer does. Null and empty texts, and those
    that the tokens of either do not spell byte by byte, have zeros and an empty `groups_sha256`.
    Equal documents, ids and texts are counted each; other columns are ignored; an empty table
    gives no rows. A text is tokenised whole, so memory grows with the longest one.
    """
    tokens = tokenised(docs, id_col, text_col, first, second)
    counts = written(counted(tokens, first, second), "counts")
    kind = docs.schema[id_col].dataType.simpleString()
    sums = "key bigint, n_best bigint, count_sum bigint"
    every = sums + f", n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, doc_id {kind}"
    total = counts.count()
    slices = max(1, -(-total // limit))
    passes = []
    for i in range(slices):
        mine = counts if slices == 1 else counts.filter(F.pmod(F.xxhash64("pair"), F.lit(slices)) == i)
        # At most `limit` pairs or so come to the driver at once.
        rows = mine.select("pair", (F.col("n") * 2 + F.col("best").cast("bigint")).alias("value")).toArrow()
        keys, value = (rows.column(c).to_numpy() for c in ("pair", "value"))
        by = np.argsort(keys)
        sent = docs.sparkSession.sparkContext.broadcast((keys[by].tobytes(), value[by].tobytes()))
        made = tokens.mapInArrow(_look_up(first, second, sent, i == 0), every if i == 0 else sums)
        if slices > 1:
            made = written(made, "looked")
            sent.unpersist(blocking=True)
        passes.append(made)
    result = passes[0]
    if slices > 1:
        more = functools.reduce(DataFrame.union, [p.select("key", "n_best", "count_sum") for p in passes])
        more = more.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        result = result.drop("n_best", "count_sum").join(more, "key")
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return result.select(*cols)


def pair_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: str = BYTE_LEVEL, second: str = PIECES
) -> DataFrame:
    """(a, b, n, best): ids whose tokens overlap somewhere, in how many documents, and whether no other b has more for a."""
    counts = counted(tokenised(docs, id_col, text_col, first, second), first, second)
    n_b = pieces(second).n
    a, b = F.expr(f"pair div {n_b}").cast("int"), (F.col("pair") % n_b).cast("int")
    return counts.select(a.alias("a"), b.alias("b"), "n", "best")


def _spans(first: str, second: str):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _batches(batches, first, second):
            ends_a, ends_b = np.cumsum(x.n_a), np.cumsum(x.n_b)
            low = np.full(len(x.a), np.iinfo(np.int64).max)
            high = np.full(len(x.a), -1)
            np.minimum.at(low, x.link_a, x.link_b)
            np.maximum.at(high, x.link_a, x.link_b)
            closes_a = np.flatnonzero(np.diff(x.group_a, append=1 + x.group_a.max(initial=-1)) > 0)
            closes_b = np.flatnonzero(np.diff(x.group_b, append=1 + x.group_b.max(initial=-1)) > 0)
            rows: list = [None] * len(x.order)
            for k, i in enumerate(x.order.tolist()):
                a0, a1, b0, b1 = ends_a[k] - x.n_a[k], ends_a[k], ends_b[k] - x.n_b[k], ends_b[k]
                mine = slice(*np.searchsorted(closes_a, [a0, a1]))
                rows[i] = (
                    x.a[a0:a1], x.b[b0:b1], closes_a[mine] - a0 + 1, closes_b[mine] - b0 + 1,
                    low[a0:a1] - b0, high[a0:a1] - b0 + 1,
                )
            cols = [byte_bpe.lists([r[c] for r in rows]) for c in range(6)]
            names = ["a", "b", "group_ends_a", "group_ends_b", "low", "high"]
            yield pa.RecordBatch.from_arrays([part.column(3), *cols], names=["doc_id", *names])

    return fn


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: str = BYTE_LEVEL, second: str = PIECES
) -> DataFrame:
    """Per document the ids `a` and `b`, where groups end in both, and for each of `a` its range of `b`.

    Token i of `a` overlaps tokens low[i] up to but without high[i] of `b`; group k is closed by
    token group_ends_a[k] - 1 of `a` and group_ends_b[k] - 1 of `b`. Lists are empty where `digest` has zeros.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    lists = ", ".join(f"{c} array<int>" for c in ("a", "b", "group_ends_a", "group_ends_b", "low", "high"))
    return tokenised(docs, id_col, text_col, first, second).mapInArrow(_spans(first, second), f"doc_id {kind}, {lists}")
