"""From raw documents to packed training sequences, one written table a stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelspark import scratch
from reelspark.llm.exact_dedup import keep_one_row as one_of_equals
from reelspark.llm.jaccard import keep_one_row as one_of_similar
from reelspark.llm.mixing import repeat_by_mix
from reelspark.llm.packing import pack
from reelspark.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not judge toxic."""
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return one_of_equals(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_similar(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return repeat_by_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last writes a table in the shared folder, and what it or the stage before wrote besides goes when that is there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, point = docs, scratch.mark()
        docs = scratch.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        scratch.removed_since(spark, point, keep=docs)
        scratch.removed(before)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fitted models, hashing and best fit are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None
