"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share all words by weight, none above a multiple of its own size; what such a limit leaves
is shared again. A source takes as many complete epochs of itself as fit its target. The rest is a
sample: every document draws an exponential key divided by its quality weight, and documents are
taken in the order of their keys up to the words that are left.

Sorting and summing within a source do not need the source in one place: documents are range-partitioned
by source and key, sums run inside the partitions, and each partition's sum per source is carried to
the partitions behind it. Documents move once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldex.functions.sizing import fits_broadcast
from foldex.llm.common import utf8, written

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source, and so no document, is taken more often than this.
MAX_REPEATS = 3
LETTERS = bytes(b for b in range(256) if chr(b).isalpha() and b < 128 or b >= 128)


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text, its bytes, and its bytes that are letters."""
    for batch in batches:
        texts = [t or b"" for t in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([
            *[batch.column(c) for c in batch.schema.names if c != "text"],
            pa.array([len(t.split()) for t in texts], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([len(t) - len(t.translate(None, LETTERS)) for t in texts], pa.int64()),
        ], [*[c for c in batch.schema.names if c != "text"], "size", "n_bytes", "n_letters"])


def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the same source before each row; a partition comes in the order of its sources."""
    source, total = None, 0
    for batch in batches:
        before = []
        for name, size in zip(batch.column("source").to_pylist(), batch.column("size").to_pylist()):
            if name != source:
                source, total = name, 0
            before.append(total)
            total += size
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], [*batch.schema.names, "run"])


def quality() -> Column:
    """The weight of a document, a quarter to one: more for a larger share of letters (and bytes over 127)."""
    return F.lit(0.25) + F.lit(0.75) * F.coalesce(F.try_divide("n_letters", "n_bytes"), F.lit(0.0))


def draw() -> Column:
    """A uniform number above 0 and below 1 from the doc_id, the same in every run."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / 2.0**48


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source: source_size and target. One row per source goes through the windows."""
    at = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.row_number().over(at) - 1) % len(WEIGHTS) + 1)
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    # Filling by weight: the sources are limited in the order of limit / weight. The level at a
    # source shares what earlier limits leave among it and the later ones; it is highest where limits stop.
    limit = MAX_REPEATS * F.col("source_size")
    order = W.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    level = sources.withColumn("level", left / F.sum("weight").over(after))
    target = F.least(limit.cast("double"), F.col("weight") * F.max("level").over(everything))
    return level.select("source", "source_size", target.alias("target"))


def mixed_sources(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Per document doc_id, size, source_size, target and taken (words), and the columns to ``carry``.

    Null text has size 0, is never drawn and takes 0. Null is a source of its own, the last. Each row is
    a document: repeated rows draw one key and are taken one after another. A document is taken when half
    of it still fits, so a source misses its target by half a document at most.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in carry or []] or [F.lit(0).alias("none")]).alias("doc")
    # Rows of one doc_id that tie otherwise go by their texts, so that reruns agree.
    narrow = docs.select(carried, F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.xxhash64("text").alias("mark"), "text")
    kinds = narrow.drop("text").schema.add("size", "long").add("n_bytes", "long").add("n_letters", "long")
    sizes = narrow.mapInArrow(measured, kinds)
    key = -F.log(draw()) / quality()
    order = ["source", "key", "doc_id", "size", "mark"]
    ranged = sizes.select("doc", "doc_id", "source", "size", key.alias("key"), "mark").repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).drop("key", "mark")
    sizes = written(ranged.mapInArrow(running, ranged.limit(0).schema.add("run", "long")), "mix")

    # One row per partition and source, and one more per further source of a partition.
    parts = sizes.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("source", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("carried"))
    targets = source_targets(sizes).withColumnRenamed("source", "own")
    offsets = written(parts.join(targets, F.col("source").eqNullSafe(F.col("own"))).drop("own"), "mix-offsets")
    offsets = offsets.withColumnsRenamed({"source": "own", "part": "own_part"})
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    joined = sizes.join(offsets, F.col("source").eqNullSafe(F.col("own")) & (F.col("part") == F.col("own_part")))
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    more = F.col("target") - epochs * F.col("source_size")
    chosen = (F.col("size") > 0) & (F.col("carried") + F.col("run") + F.col("size") / 2 <= more)
    taken = F.col("size") * (epochs + chosen.cast("bigint"))
    return joined.select(*(["doc"] if carry else []), "doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def mixture(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    taken = mixed_sources(docs, docs.columns)
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return taken.withColumn("again", F.explode(F.array_repeat(F.lit(0), times))).select(
        *[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
