"""The corpus pipeline: documents go through the stages in order, each written and read again before the next.

The table that comes out has the columns of documents and `ids`, the ids of the text as little-endian unsigned 32-bit
integers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import bpe, classifier, decontaminate, jaccard, secret_scan
from rollcall.llm.queries import TOKENIZER
from rollcall.llm.shared import keep, scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows and bytes of the batches in which texts go to Python workers. Those of all stages stay alive between their tasks,
#: so Spark's own 10,000 rows and 64 MB, in several buffers each, would add up beside the executor's heap.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def in_small_batches(stage: Stage) -> Stage:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in BATCHES.items():
            spark.conf.set(name, value)
        return stage(spark, docs, sf_dir)

    return run


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; it learns from those of them that are labelled."""
    return classifier.accepted(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return jaccard.representatives(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secret_scan.redacted(docs, length="n_chars")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the ids of their texts."""
    return bpe.encode(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality", in_small_batches(good)),
    ("near_duplicates", in_small_batches(unique)),
    ("decontamination", unseen),
    ("secrets", in_small_batches(redacted)),
    ("encode", in_small_batches(encoded)),
]

#: Trees, set similarity and merges can't be written in SQL; a test holds the run against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
