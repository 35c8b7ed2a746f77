"""Benchmark decontamination with one Aho-Corasick automaton over the items' word windows.

Texts and items are normalised alike: A-Z in lower case, everything but 0-9, a-z and bytes from
0x80 on becomes one space. The automaton holds the windows with a space on either side, so one
pass over a normalised text finds all of them at word boundaries, however they overlap. Found
windows are mapped back to word numbers and, for texts with a hit, to character offsets.

The benchmark is a stated query set. Its windows are cut into blocks of at most `block_bytes`;
each block's items are broadcast as they are, and every Python worker builds the automaton of a
block once. The usual benchmark is one block; with more, the documents are scanned once a block.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.exchange import written
from chronoloom.llm.text import give_back

_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
WINDOW = 13
BLOCK_BYTES = 8 << 20
_built: dict[str, tuple] = {}


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_TABLE).split()


def windows(words: list[bytes], size: int) -> list[list[bytes]]:
    if not words:
        return []
    return [words[i : i + size] for i in range(max(1, len(words) - size + 1))]


class Matcher:
    """Automaton over (item id, text) pairs; item ids may repeat and may be None."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int = WINDOW):
        self.automaton = ahocorasick.Automaton()
        self.items: list[set[str]] = []
        for item, text in items:
            for w in windows(normal_words(text), size):
                key = " " + b" ".join(w).decode("latin-1") + " "
                at = self.automaton.get(key, None)
                if at is None:
                    at = (len(self.items), len(w), len(key))
                    self.automaton.add_word(key, at)
                    self.items.append(set())
                if item is not None:
                    self.items[at[0]].add(item)
        if self.items:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, merged ranges (first, last) of hit words, items found."""
        words = normal_words(text)
        if not words or not self.items:
            return len(words), [], []
        line = " " + b" ".join(words).decode("latin-1") + " "
        found = list(self.automaton.iter(line))
        if not found:
            return len(words), [], []
        spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        lasts = np.searchsorted(spaces, [end for end, _ in found]) - 1
        ranges = sorted((int(x) - n + 1, int(x)) for x, (_, (_, n, _)) in zip(lasts, found))
        merged = [ranges[0]]
        for a, b in ranges[1:]:
            if a <= merged[-1][1] + 1:
                merged[-1] = (merged[-1][0], max(merged[-1][1], b))
            else:
                merged.append((a, b))
        return len(words), merged, sorted(set().union(*(self.items[i] for _, (i, _, _) in found)))


def character_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of ranges of normalised words."""
    at = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    return [(at[a][0], at[b][1]) for a, b in ranges]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The items in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    for r in rows.filter("t is not null").toLocalIterator():
        # A window is stored once for each of its words, so an item costs WINDOW times its size.
        cost = WINDOW * len(r.t)
        if block and size + cost > block_bytes:
            yield block
            block, size = [], 0
        block.append((r.i, r.t))
        size += cost
    yield block


def _scanner(items, size: int, name: str):
    def fn(batches):
        if name not in _built:
            _built.clear()
            _built[name] = Matcher(items.value, size)
        matcher = _built[name]
        for batch in batches:
            found = [matcher.scan(t) for t in batch.column(0).to_pylist()]
            texts = batch.column(0)
            spans = [
                character_spans(texts[i].as_py(), hits) if hits else [] for i, (_, hits, _) in enumerate(found)
            ]
            pair = lambda rs, names: [[dict(zip(names, r)) for r in x] for x in rs]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array(pair([h for _, h, _ in found], ("first", "last")), _RANGE),
                    pa.array([i for _, _, i in found], pa.list_(pa.string())),
                    pa.array(pair(spans, ("start", "end")), _SPAN),
                    *batch.columns[1:],
                ],
                names=["n_words", "hits", "items", "spans", *batch.schema.names[1:]],
            )
        give_back()

    return fn


_RANGE = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def n_hit(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, r: a + r["last"] - r["first"] + 1)


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with a struct `found` of n_words, n_hit, items, spans and contaminated.

    A window is `window` consecutive words of an item, or all words of a shorter one; a word
    inside an occurrence of a window is hit. `items` are the sorted ids, as strings, of items
    with an occurring window; an item with a null id hits but is not listed. `spans` are the
    character ranges of hit words in the original text. A document is contaminated if words are
    hit and they are at least a twentieth of all. A null text has no words, an item without
    words no window. A column called `found` is replaced; all others are kept as they are.
    """
    spark = docs.sparkSession
    cols = [c for c in docs.columns if c != "found"]
    # The other columns pass through Python as one struct, so that no name can clash.
    packed = docs.select(F.col(text_col).alias("text"), F.struct(*[F.col(c) for c in cols]).alias("row"))
    row_type = packed.schema["row"].dataType.simpleString()
    base = (
        "n_words bigint, hits array<struct<first: bigint, last: bigint>>, items array<string>, "
        "spans array<struct<start: bigint, end: bigint>>"
    )
    blocks = [
        (f"{uuid.uuid4().hex}", spark.sparkContext.broadcast(b))
        for b in _blocks(benchmark, item_id, item_text, block_bytes)
    ]
    if len(blocks) == 1:
        name, items = blocks[0]
        found = packed.mapInArrow(_scanner(items, window, name), f"{base}, row {row_type}")
    else:
        found = _merged(packed, blocks, window, base)
    hit = n_hit(F.col("hits"))
    flag = (hit > 0) & (20 * hit >= F.col("n_words"))
    out = F.struct("n_words", hit.alias("n_hit"), "items", "spans", flag.alias("contaminated"))
    return found.select("row.*", out.alias("found"))


def _merged(packed: DataFrame, blocks: list, window: int, schema: str) -> DataFrame:
    """Findings of several blocks, brought together by row."""
    numbered = written(packed.withColumn("n", F.monotonically_increasing_id()), "numbered")
    every = None
    for name, items in blocks:
        part = numbered.select("text", "n").mapInArrow(_scanner(items, window, name), schema + ", n bigint")
        every = part if every is None else every.union(part.filter("size(hits) > 0"))

    def flat(c: str) -> Column:  # one list for each block of a row
        return F.flatten(F.collect_list(c))

    joined = every.groupBy("n").agg(
        F.max("n_words").alias("n_words"),
        _union(F.array_sort(flat("hits")), "first", "last").alias("hits"),
        F.array_sort(F.array_distinct(flat("items"))).alias("items"),
        _union(F.array_sort(flat("spans")), "start", "end").alias("spans"),
    )
    return joined.join(numbered.select("n", "row"), "n").select("n_words", "hits", "items", "spans", "row")


def _union(ranges: Column, a: str, b: str) -> Column:
    """Sorted ranges with touching ones made one."""

    def add(done: Column, r: Column) -> Column:
        end = F.element_at(done, -1)
        longer = F.struct(end[a].alias(a), F.greatest(end[b], r[b]).alias(b))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))
        touches = (F.size(done) > 0) & (r[a] <= F.try_element_at(done, F.lit(-1))[b] + 1)
        return F.when(touches, joined).otherwise(F.concat(done, F.array(r)))

    none = F.expr(f"cast(array() as array<struct<{a}: bigint, {b}: bigint>>)")
    return F.aggregate(ranges, none, add)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        F.col(id_col).alias("doc_id"),
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        "found.contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with."""
    found = scan(docs, benchmark, **options)
    return found.filter(~F.col("found.contaminated")).drop("found")
