"""Connected components of a graph of 64-bit node numbers, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.exchange import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the star algorithm: neighbours move over to the least one."""
    if large:
        near = edges.union(edges.select("v", "u")).toDF("u", "v")
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = near.join(least, "u")
    if large:
        moved = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node number that edges (u, v) connect each node with.

    Alternates the large and small star steps of Kiveris et al. until nothing moves; every round
    is written to the shared folder. A hub is reduced by a partial aggregation, and the join has
    one row on its right side for each node, so a hot one can be split. Nodes without an edge to
    another one are not in the result.
    """
    edges = written(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            hubs = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return stars.union(hubs)
        before = mark
        edges = written(_star(_star(edges, True), False), "edges")
