"""Buckets of documents, and the question which hashed keys occur more than once.

The documents are dealt once into buckets of bounded size. A bucket sends each of its distinct
64-bit keys once with its count, packed by the partition that answers for it, and gets back
three bits a key: whether it occurs more than once, whether this bucket is the first to have
it, and whether it occurs very often. However often a key occurs, one bucket sends it once, so
no key makes a partition hot.

Where a key that is taken for repeated by mistake costs only work, keys can be sent short: even
ones by their lower 32 bits, which beside the partition tell all but a few in a thousand
apart, and odd ones, whose answers must be right, whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.text import U, give_back
from chronoloom.shared import shared_dir

BUCKET = "__bucket"
PAGE = 1 << 20
_ANSWER = f"{BUCKET} int, target int, bits binary"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the cluster's shared folder; cuts the lineage.

    Nobody needs the shuffles behind it then, but Spark removes their files only once the driver's
    JVM has collected what refers to them, by itself every half hour. So it is asked to, after a
    small job, as the scheduler refers to the last job until the next one.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.limit(1).count()
    spark.sparkContext._jvm.System.gc()
    return table


class Buckets:
    """Documents with their bucket; `total` is the number of text bytes.

    Buckets hold about `page` bytes of text; one longer text is a bucket's only large one with
    high likelihood. Rows of one bucket are ordered by id and text, so that a row number means
    the same row each time the bucket is read. Equal rows are interchangeable.
    """

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, page: int = PAGE):
        self.id_col, self.text_col = id_col, text_col
        size = docs.agg(
            F.sum(F.octet_length(text_col)).alias("b"), F.count(F.lit(1)).alias("n")
        ).first()
        self.total = (size.b or 0) + 64 * size.n
        self.n = max(1, math.ceil(self.total / page))
        key = F.xxhash64(F.col(id_col), F.col(text_col))
        self.df = docs.withColumn(BUCKET, F.pmod(key, F.lit(self.n)).cast("int"))

    def thin(self) -> DataFrame:
        """Bucket, id and text only; equal plans, so that Spark deals the documents once."""
        return self.df.select(BUCKET, F.col(self.id_col).alias("id"), F.col(self.text_col).alias("text"))


def ordered(table: pa.Table, id_col: str = "id", text_col: str = "text") -> pa.Table:
    keys = [(c, "ascending") for c in (id_col, text_col)]
    picked = table.select([id_col, text_col])
    return table.take(pc.sort_indices(picked, sort_keys=keys, null_placement="at_start"))


def text_bytes(table: pa.Table, text_col: str = "text") -> list[bytes | None]:
    return table.column(text_col).cast(pa.binary()).to_pylist()


def target_of(keys: np.ndarray, targets: int) -> np.ndarray:
    """Answering partition; ascending with the key."""
    return (((keys >> U(32)) * U(targets)) >> U(32)).astype(np.int64)


def _pack(keys: np.ndarray, short: bool) -> bytes:
    """The keys; with `short` the lower halves of all, then the upper halves of the odd ones."""
    if not short:
        return keys.tobytes()
    odd = keys[(keys & U(1)) == 1]
    return keys.astype("<u4").tobytes() + (odd >> U(32)).astype("<u4").tobytes()


def _unpack(pack: bytes, n: int, short: bool) -> np.ndarray:
    """The n keys of a pack, even ones without their upper half if they were sent short."""
    if not short:
        return np.frombuffer(pack, U)
    halves = np.frombuffer(pack, "<u4")
    keys = halves[:n].astype(U)
    keys[(keys & U(1)) == 1] |= halves[n:].astype(U) << U(32)
    return keys


def _ask(keys_of: Callable, targets: int, count_type: str, short: bool) -> Callable:
    def ask(table: pa.Table) -> pa.Table:
        bucket = table.column(BUCKET)[0].as_py()
        keys, counts = np.unique(keys_of(ordered(table)), return_counts=True)
        cut = np.searchsorted(target_of(keys, targets), np.arange(targets + 1))
        have = np.flatnonzero(np.diff(cut))
        give_back()
        counts = np.minimum(counts, np.iinfo(count_type).max).astype(count_type)
        return pa.table(
            {
                "target": pa.array(have, pa.int32()),
                BUCKET: pa.array(np.full(len(have), bucket), pa.int32()),
                "keys": pa.array([_pack(keys[cut[t] : cut[t + 1]], short) for t in have], pa.binary()),
                "counts": pa.array([counts[cut[t] : cut[t + 1]].tobytes() for t in have], pa.binary()),
            }
        )

    return ask


def _answer(hot: int, count_type: str, short: bool) -> Callable:
    width = np.dtype(count_type).itemsize

    def answer(table: pa.Table) -> pa.Table:
        buckets = table.column(BUCKET).to_numpy()
        order = np.argsort(buckets, kind="stable")
        packs = table.column("counts").to_pylist()
        sizes = np.array([len(packs[i]) // width for i in order])
        counts = np.frombuffer(b"".join(packs[i] for i in order), count_type)
        packs = table.column("keys").to_pylist()
        keys = np.concatenate([_unpack(packs[i], n, short) for i, n in zip(order, sizes)])
        by = np.argsort(keys, kind="stable")  # equal keys stay in the order of their buckets
        fresh = np.concatenate(([True], keys[by][1:] != keys[by][:-1]))
        totals = np.add.reduceat(counts[by], np.flatnonzero(fresh), dtype=np.int64)[np.cumsum(fresh) - 1]
        planes = np.zeros((3, len(keys)), bool)
        planes[:, by] = totals > 1, fresh, totals > hot
        ends = np.cumsum(sizes)
        bits = [np.packbits(planes[:, e - n : e]).tobytes() for e, n in zip(ends, sizes)]
        del packs, keys, counts, by, totals
        give_back()
        return pa.table(
            {
                BUCKET: pa.array(buckets[order], pa.int32()),
                "target": table.column("target").take(pa.array(order)).cast(pa.int32()),
                "bits": pa.array(bits, pa.binary()),
            }
        )

    return answer


def ask_repeated(
    buckets: Buckets, keys_of: Callable, bytes_a_key: float, hot: int = 1 << 62, short: bool = False
) -> tuple[DataFrame, int]:
    """Answers by bucket for the keys that `keys_of(ordered table)` finds in it.

    `bytes_a_key` estimates how much text has one key; it only sets the number of partitions. With
    `short`, a few even keys are said to be repeated, late or hot that are not; odd ones never.
    """
    targets = max(1, math.ceil(buckets.total / bytes_a_key / 400_000))
    # Unless very frequent keys are asked for, it only matters whether a count is over one, or a few.
    count_type = "u1" if hot >= 1 << 62 or hot < 255 else "<u4"
    asked = (
        buckets.thin()
        .groupBy(BUCKET)
        .applyInArrow(_ask(keys_of, targets, count_type, short), f"target int, {BUCKET} int, keys binary, counts binary")
    )
    return asked.groupBy("target").applyInArrow(_answer(hot, count_type, short), _ANSWER), targets


def read_answers(keys: np.ndarray, answers: pa.Table, targets: int) -> np.ndarray:
    """Three rows of flags for the keys: occurs more than once, no earlier bucket has it, is hot."""
    u, inverse = np.unique(keys, return_inverse=True)
    flags = np.zeros((3, len(u)), bool)
    cut = np.searchsorted(target_of(u, targets), np.arange(targets + 1))
    for t, bits in zip(answers.column("target").to_pylist(), answers.column("bits").to_pylist()):
        n = cut[t + 1] - cut[t]
        got = np.unpackbits(np.frombuffer(bits, np.uint8), count=3 * n).reshape(3, n)
        flags[:, cut[t] : cut[t + 1]] = got
    return flags[:, inverse]


def bucket_map(buckets: Buckets, other: DataFrame, fn: Callable, schema: str, full: bool = False) -> DataFrame:
    """fn(ordered documents, other's rows of the bucket) for every bucket with documents."""
    docs = buckets.df if full else buckets.thin()
    id_col, text_col = (buckets.id_col, buckets.text_col) if full else ("id", "text")

    def both(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out = fn(ordered(mine, id_col, text_col), theirs)
        give_back()
        return out

    return docs.groupBy(BUCKET).cogroup(other.groupBy(BUCKET)).applyInArrow(both, schema)
