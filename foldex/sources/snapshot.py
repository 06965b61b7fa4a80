"""Snapshots of whole collections, the input of backfill and rebuild."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldex.model import INSERT, NAMESPACE


def snapshot(table: DataFrame, database: str | Column, collection: str | Column, key: Column,
             fields: list[str] | None = None) -> DataFrame:
    """Documents of one or more collections: ``database, collection, uid, doc``.

    Only the columns the rules later touch are read: the document struct is pruned away.
    """
    def text(v):
        return v if isinstance(v, Column) else F.lit(v)

    names = fields or table.columns
    return table.select(
        text(database).alias("database"),
        text(collection).alias("collection"),
        key.cast("string").alias("uid"),
        F.struct(*names).alias("doc"),
    )


def scan_collections(documents: DataFrame, collections: list[str]) -> DataFrame:
    """The documents of the given collections; on partitioned tables this prunes partitions."""
    return documents.where(F.col("collection").isin(list(collections)))


def source_counts(documents: DataFrame) -> DataFrame:
    """Number of source documents per collection."""
    return documents.groupBy(*NAMESPACE).agg(F.count(F.lit(1)).alias("n"))


def document_upserts(documents: DataFrame, first_seq: int) -> DataFrame:
    """Documents as insert changes, for indexing outside the feed: ``seq`` is ``first_seq`` for all.

    Keys must be unique in ``documents``.
    """
    return documents.select(
        F.lit(first_seq).cast("bigint").alias("seq"), F.lit(INSERT).alias("op"), *NAMESPACE, "uid", "doc"
    )
