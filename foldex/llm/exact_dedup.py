"""Exact duplicates by distributed most-significant-digit radix partitioning.

A text is written as its length followed by its bytes, white space removed. Groups of documents are
split by the length, then by the next bytes, then by more of them, until a group holds one document
or its texts have ended: then they are equal, byte by byte, without any digest. A round looks at
``growth`` times as many bytes as the one before, so even very long texts need few rounds, and only
documents whose group still has two or more take part. A group is named by its smallest row number,
which Spark finds by aggregates combined on the map side, so a group may hold any share of all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldex.llm.common import WHITE, utf8, written

HEAD = 64


def normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: code points of the text, and the text without white space with its size, head and SHA-256."""
    for batch in batches:
        texts = [t or b"" for t in utf8(batch.column("text"))]
        points = pa.compute.utf8_length(batch.column("text").fill_null(""))
        bodies = [t.translate(None, WHITE.encode()) for t in texts]
        yield pa.RecordBatch.from_arrays([
            batch.column("row"), batch.column("doc_id"), points.cast(pa.int64()),
            pa.array(map(len, bodies), pa.int64()),
            pa.array([b[:HEAD] for b in bodies], pa.binary()),
            pa.array([hashlib.sha256(b).hexdigest() for b in bodies], pa.string()),
            pa.array(bodies, pa.binary()),
        ], ["row", "doc_id", "points", "size", "head", "text_sha256", "body"])


def split(active: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``active`` whose ``keys`` another row shares, with the group's smallest row as ``group``."""
    groups = active.groupBy(*keys).agg(F.min("row").alias("_group"), F.count(F.lit(1)).alias("_n"))
    groups = written(groups.where("_n > 1").drop("_n"), "radix-groups")
    return active.join(groups, keys).drop("group").withColumnRenamed("_group", "group")


def exact_duplicates(docs: DataFrame, growth: int = 16) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; all empty texts are equal. Of a group the row with the most code
    points in its original text stays, then the smallest doc_id (null last), then the first row, so
    of repeated rows one is kept. An empty table gives an empty result. Other columns are ignored.
    """
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), "text")
    base = written(narrow.mapInArrow(
        normalised, "row long, doc_id long, points long, size long, head binary, text_sha256 string, body binary"),
        "radix-texts")

    active = written(split(base.select("row", "size", "head"), ["size", "head"]).select("row", "size", "group"), "radix")
    ended = [active.where(F.col("size") <= HEAD).select("row", "group")]
    active = active.where(F.col("size") > HEAD).join(
        base.select("row", F.substring("body", HEAD + 1, 2**31 - 1).alias("rest")), "row")
    width = HEAD
    while not active.isEmpty():
        width = min(width * growth, 2**30)
        step = split(active.withColumn("digits", F.substring("rest", 1, width)), ["group", "digits"])
        step = written(step.select("row", "group", F.substring("rest", width + 1, 2**31 - 1).alias("rest")), "radix")
        ended.append(step.where(F.octet_length("rest") == 0).select("row", "group"))
        active = step.where(F.octet_length("rest") > 0)

    equal = ended[0]
    for more in ended[1:]:
        equal = equal.unionByName(more)
    members = equal.join(base.select("row", "doc_id", "points"), "row")
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    kept = members.groupBy("group").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    found = members.select("row", "group").join(written(kept, "radix-kept"), "group").select(
        "row", "group_size", F.col("best.doc_id").alias("best_id"), F.col("best.row").alias("best_row"))
    alone = F.col("group_size").isNull()
    return base.select("row", "doc_id", "text_sha256").join(found, "row", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("best_row"))).alias("kept"),
        "text_sha256",
    )
