"""A training corpus from raw documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoloom.llm import debruijn, decontaminate, jaccard_join, pieces, quality
from chronoloom.llm.exchange import written

#: SQL has no word for the later stages; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are taken out; documents that lose too much or fail the base rules go."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays: sets of five-word runs, 80 percent alike."""
    return jaccard_join.keep_one(docs, words=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words that start earlier are cut; documents left without a word go."""
    return debruijn.cut_passages(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they decode to its text."""
    return pieces.encode(docs, lossless=True).select("doc_id", "pieces", "lossless")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the stages before are written to the cluster's shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, "stage")
    return docs
