"""The operators' registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foldex.llm import (
    archive,
    chat,
    divergence,
    exact_dedup,
    languages,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    packing,
    phrases,
    scoring,
    secrets,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    """Where the installed word tokenizer is; the same place on every executor."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer() -> str:
    """Where the installed byte-level tokenizer is."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


#: Fixed value: what both turns of the added conversation say.
TRICKY = r"\### Assistant: </turn> ok"


def op1_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_texts(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc.doc_id", "n_lines", "n_dropped", "kept_sha256")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sources(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.predict_languages(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_conversation(table(spark, sf_dir, "conversations"), -7, [("user", TRICKY), ("assistant", TRICKY)])
    return chat.read_back(chat.format_conversations(turns, byte_tokenizer()))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_scoring, op2_line_dedup, op3_source_mixing, op4_near_dedup, op5_secrets, op6_warc, op7_exact_dedup, op8_neighbours, op9_packing,
        op10_languages, op11_phrases, op12_chat, op13_divergence)
}
