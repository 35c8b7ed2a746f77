"""Removal of repeated word passages on a compacted de Bruijn graph of the corpus.

Every run of `k` words is an edge. A graph with a row per edge would be as large as the corpus
many times over, so it is built compacted:

* A node is a run of `anchor` words. Each edge belongs to the node with the lowest hash inside
  it, which its words alone decide. Edges of one node that follow each other in a document have
  no branch between them and are one row, a path.
* Paths through nodes that occur once repeat nothing and are dropped (`exchange`).
* Spark joins each path's occurrences with its first one. At a node with one path there is no
  branch, and all later occurrences are copies, whole. Only where a node has several different
  paths, the first occurrence of each is opened into its edges, and these are compared.
* Copied paths that follow each other, with sources that follow each other as well, compact into
  one long span, whose source coordinates cover the span without a gap.

Paths and edges are equal if two 64-bit hashes of their words are, a polynomial and a sum of mixed
values, over two different hashes of each word.

Hot passages: of equal paths in a bucket only the first is joined, the others are copies of it;
likewise an edge is sent once by a bucket. So a passage that a third of all documents share is
one row for each bucket of documents, and a partial aggregation reduces these to the first.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.exchange import (
    BUCKET,
    Buckets,
    ask_repeated,
    bucket_map,
    read_answers,
    text_bytes,
    written,
)
from chronoloom.llm.text import Texts, U, covered, mix, runs_digest, runs_hash, window_min

KEYS = ["node", "path", "path2"]


class _Paths:
    """The paths of a bucket: node, first edge's first word, number of edges."""

    def __init__(self, table: pa.Table, k: int, anchor: int):
        self.texts = t = Texts(text_bytes(table)).find_words()
        self.h = h = t.word_hashes()
        n = len(h)
        self.start = self.width = np.zeros(0, np.int64)
        self.node = np.zeros(0, U)
        if n < k:
            return
        at = np.arange(n - anchor + 1)
        g = mix(runs_hash(h, at, at + anchor))
        bits = U(max(1, n.bit_length()))
        low = window_min(((g >> bits) << bits) | at.astype(U), k - anchor + 1)
        last = np.repeat(t.first[1:], np.diff(t.first))
        edge = np.flatnonzero(np.arange(n) + k <= last)
        if not len(edge):
            return
        where = (low[edge] & ((U(1) << bits) - U(1))).astype(np.int64)
        fresh = np.concatenate(([True], (np.diff(edge) != 1) | (np.diff(where) != 0)))
        cut = np.flatnonzero(fresh)
        self.start, self.node = edge[cut], g[where[cut]]
        self.width = np.diff(np.append(cut, len(edge)))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U).view(np.int64))


def _occurrences(k: int, anchor: int, answering: int):
    """Rows for the paths of a bucket whose node occurs more than once."""

    def fn(table: pa.Table, answers: pa.Table) -> pa.Table:
        p = _Paths(table, k, anchor)
        keep = np.flatnonzero(read_answers(p.node, answers, answering)[0])
        start, width = p.start[keep], p.width[keep]
        t, stop = p.texts, start + width + k - 1
        row = np.searchsorted(t.first, start, "right") - 1
        node, one = p.node[keep], runs_hash(p.h, start, stop)
        two = runs_digest(t.word_hashes(1), start, stop)
        by = np.lexsort((start, two, one, node))
        again = np.zeros(len(by), bool)
        for x in (node, one, two):
            again[1:] |= x[by][1:] != x[by][:-1]
        again = ~again
        again[:1] = False
        # The first equal path in the bucket, for those that have one before them.
        lead = np.maximum.accumulate(np.where(again, 0, np.arange(len(by))))
        source = np.empty(len(by), np.int64)
        source[by] = by[lead]
        known = source != np.arange(len(by))
        return pa.table(
            {
                "node": _signed(node),
                "path": _signed(one),
                "path2": _signed(two),
                "known": pa.array(known),
                "src_row": pa.array(row[source], pa.int32()),
                "src_start": pa.array((start - t.first[row])[source], pa.int32()),
                "id": table.column("id").take(pa.array(row)),
                BUCKET: pa.array(np.full(len(row), table.column(BUCKET)[0].as_py()), pa.int32()),
                "row": pa.array(row, pa.int32()),
                "start": pa.array(start - t.first[row], pa.int32()),
                "width": pa.array(width, pa.int32()),
            }
        )

    return fn


def _opened(k: int, targets: int):
    """Edges of the paths to be compared; those with an earlier equal in the bucket are known."""

    def fn(table: pa.Table, paths: pa.Table) -> pa.Table:
        t = Texts(text_bytes(table)).find_words()
        bucket = table.column(BUCKET)[0].as_py()
        row, start, width = (paths.column(c).to_numpy().astype(np.int64) for c in ("row", "start", "width"))
        first = np.repeat(t.first[row] + start, width)
        at = first + np.arange(len(first)) - np.repeat(np.cumsum(width) - width, width)
        at = np.unique(at)
        one, two = runs_hash(t.word_hashes(), at, at + k), runs_digest(t.word_hashes(1), at, at + k)
        by = np.lexsort((at, two, one))
        again = np.zeros(len(at), bool)
        again[by[1:]] = (one[by][1:] == one[by][:-1]) & (two[by][1:] == two[by][:-1])
        row = np.searchsorted(t.first, at, "right") - 1
        target = (mix(one) % U(targets)).astype(np.int64)
        return pa.table(
            {
                "target": pa.array(np.where(again, -1 - bucket, target), pa.int32()),
                "one": _signed(one),
                "two": _signed(two),
                "id": table.column("id").take(pa.array(row)),
                BUCKET: pa.array(np.full(len(at), bucket), pa.int32()),
                "row": pa.array(row, pa.int32()),
                "start": pa.array(at - t.first[row], pa.int32()),
            }
        )

    return fn


def _later(k: int):
    """Word ranges of the edges that have an earlier equal."""

    def fn(table: pa.Table) -> pa.Table:
        if table.column("target")[0].as_py() >= 0:
            names = ("one", "two", "id", BUCKET, "row", "start")
            keys = [(c, "ascending") for c in names]
            table = table.take(pa.compute.sort_indices(table, sort_keys=keys, null_placement="at_start"))
            one, two = (table.column(c).to_numpy() for c in names[:2])
            same = np.concatenate(([False], (one[1:] == one[:-1]) & (two[1:] == two[:-1])))
            table = table.filter(pa.array(same))
        start = table.column("start").to_numpy()
        return pa.table(
            {BUCKET: table.column(BUCKET), "row": table.column("row"), "start": pa.array(start, pa.int32()),
             "stop": pa.array(start + k, pa.int32())}
        )

    return fn


def _kept(table: pa.Table, ranges: pa.Table) -> pa.Table:
    t = Texts(text_bytes(table)).find_words()
    row, a, b = (ranges.column(c).to_numpy().astype(np.int64) for c in ("row", "start", "stop"))
    gone = covered(len(t.starts), t.first[row] + a, t.first[row] + b)
    removed = np.add.reduceat(np.append(gone, False).astype(np.int64), t.first[:-1]) if t.n else gone
    removed = np.where(np.diff(t.first) > 0, removed, 0)
    # A kept word brings the byte after it along, as a space; the last one of a text is cut off.
    stay = covered(len(t.buf), t.starts[~gone], t.ends[~gone] + 1)
    out = t.buf.copy()
    out[t.ends] = 32
    ends = np.concatenate(([0], np.cumsum(stay)))[t.offs]
    raw = out[stay].tobytes()
    return pa.table(
        {
            "doc_id": table.column("id"),
            "n_words": pa.array(np.diff(t.first), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept": pa.array([raw[x : max(x, y - 1)] for x, y in zip(ends[:-1], ends[1:])], pa.binary()),
        }
    )


def repeated_passages(buckets: Buckets, k: int = 20, anchor: int = 5) -> DataFrame:
    """Word ranges of each document row that an edge with an earlier equal covers."""
    if not 1 <= anchor < k:
        raise ValueError("anchor must be at least 1 and less than k")
    text_a_path = 6.0 * (k - anchor + 2) / 2
    answers, answering = ask_repeated(buckets, lambda t: _Paths(t, k, anchor).node, text_a_path)
    id_type = buckets.df.schema[buckets.id_col].dataType.simpleString()
    place = f"id {id_type}, {BUCKET} int, row int, start int"
    seen = written(
        bucket_map(
            buckets, answers, _occurrences(k, anchor, answering),
            f"node bigint, path bigint, path2 bigint, known boolean, src_row int, src_start int, {place}, width int",
        ),
        "paths",
    )
    at = F.struct("id", BUCKET, "row", "start", "width")
    own = seen.filter("not known")
    firsts = own.groupBy(*KEYS).agg(F.min(at).alias("first"))
    branches = firsts.groupBy("node").agg(F.count(F.lit(1)).alias("paths")).filter("paths > 1")
    opened = firsts.join(branches, "node").select("first.*").select(BUCKET, "row", "start", "width")
    targets = max(1, math.ceil(buckets.total / 6 / 500_000))
    edges = bucket_map(
        buckets, opened, _opened(k, targets), f"target int, one bigint, two bigint, {place}"
    )
    later = edges.groupBy("target").applyInArrow(_later(k), f"{BUCKET} int, row int, start int, stop int")
    there = F.struct(F.col("first")[BUCKET].alias("b"), F.col("first.row").alias("r"), F.col("first.start").alias("s"))
    here = F.struct(F.col(BUCKET).alias("b"), F.col("row").alias("r"), F.col("start").alias("s"))
    local = F.struct(F.col(BUCKET).alias("b"), F.col("src_row").alias("r"), F.col("src_start").alias("s"))
    cols = [BUCKET, "row", "start", "width"]
    copies = own.join(firsts, KEYS).filter(there != here).select(*cols, there.alias("source"))
    return later.union(_spans(copies.union(seen.filter("known").select(*cols, local.alias("source"))), k))


def _spans(copies: DataFrame, k: int) -> DataFrame:
    """Copied paths whose places and sources both follow each other, as one range each."""
    doc = Window.partitionBy(BUCKET, "row").orderBy("start")
    shift = F.struct("source.b", "source.r", (F.col("source.s") - F.col("start")).alias("d"))
    end = F.col("start") + F.col("width")
    moved = copies.select(BUCKET, "row", "start", end.alias("end"), shift.alias("shift"))
    follows = (F.lag("end").over(doc) == F.col("start")) & (F.lag("shift").over(doc) == F.col("shift"))
    span = F.sum(F.when(follows, 0).otherwise(1)).over(doc)
    return (
        moved.withColumn("span", span)
        .groupBy(BUCKET, "row", "span")
        .agg(F.min("start").alias("start"), (F.max("end") + F.lit(k - 1)).alias("stop"))
        .select(BUCKET, "row", "start", "stop")
    )


def dedup_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 20, anchor: int = 5
) -> DataFrame:
    """Per document its words, joined by one space, without those in a repeated passage.

    A word goes if a run of `k` words around it also starts earlier: in a document with a
    smaller id, or further up in the same one. Runs never cross documents and are judged on the
    input. `kept` holds UTF-8 bytes. A null text has no words; a null id sorts first, and rows
    that share an id are ordered in a fixed way; a table without rows gives none. Other columns
    are ignored.
    """
    buckets = Buckets(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words bigint, n_removed bigint, kept binary"
    return bucket_map(buckets, repeated_passages(buckets, k, anchor), _kept, schema)


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _cut(text_col: str, chars_col: str | None, id_col: str):
    def fn(table: pa.Table, ranges: pa.Table) -> pa.Table:
        narrow = pa.table({"id": table.column(id_col), "text": table.column(text_col)})
        result = _kept(narrow, ranges)
        cut = result.column("n_removed").to_numpy() > 0
        stay = ~(cut & (result.column("n_removed").to_numpy() == result.column("n_words").to_numpy()))
        kept = result.column("kept").cast(pa.string())
        text = pa.compute.if_else(pa.array(cut), kept, narrow.column("text"))
        at = table.schema.get_field_index(text_col)
        table = table.set_column(at, table.schema.field(at), text.cast(table.schema.field(at).type))
        if chars_col in table.column_names:
            at = table.schema.get_field_index(chars_col)
            n = pa.compute.if_else(pa.array(cut), pa.compute.utf8_length(text), table.column(at))
            table = table.set_column(at, table.schema.field(at), n.cast(table.schema.field(at).type))
        return table.filter(pa.array(stay)).drop_columns([BUCKET])

    return fn


def cut_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", **options
) -> DataFrame:
    """The documents with all their columns and repeated passages cut out of their texts.

    A text that loses nothing stays as it is, white space included. Documents that lose all
    their words go.
    """
    buckets = Buckets(docs, id_col, text_col)
    ranges = repeated_passages(buckets, **options)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return bucket_map(buckets, ranges, _cut(text_col, chars_col, id_col), schema, full=True)
