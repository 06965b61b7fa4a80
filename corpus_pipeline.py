"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next.

1. ``language_id`` keeps documents in a known language.
2. ``line_dedup`` takes repeated lines out of the texts.
3. ``near_dedup`` keeps one document of each class of near duplicates.
4. ``mixing`` repeats or leaves out documents so that sources come near their target weights.
5. ``packing`` cuts and packs what is left into sequences; its rows are pieces of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foldex.llm import languages, line_dedup, mixing, near_dedup, packing
from foldex.llm.common import written
from foldex.llm.queries import table, word_tokenizer


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return languages.in_known_language(docs)


def without_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, word_tokenizer(), keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", without_lines),
    ("near_dedup", without_copies),
    ("mixing", mixture),
    ("packing", packed),
]

#: SQL cannot express the language model, the tokenizer and the search; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all sequences made from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
