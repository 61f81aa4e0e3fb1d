"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage is one of the corpus operators applied to all that its predecessor kept; its
result is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm.common import documents, materialize, release
from sluiceway.llm.exact_dedup import drop_copies
from sluiceway.llm.jaccard_join import keep_one_of_each
from sluiceway.llm.language_id import keep_identified
from sluiceway.llm.mixing import draw
from sluiceway.llm.packing import pack


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a text or a letter, and those whose language scores below 0.5."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the longest of the documents that are equal but for white space."""
    return drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first of each group of documents linked by a similarity of 0.8 over 5-word shingles."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's documents as often as its target weight says, at most 3 times."""
    return draw(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences of 4096; a row per piece."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Language identification and packing can't be expressed in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, materialize(stage(spark, docs, sf_dir))
        release(spark, *[before][: i])  # a stage's input is read by none after it; the documents stay
    return STAGES[-1][1](spark, docs, sf_dir)
