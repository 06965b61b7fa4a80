"""Line deduplication: documents probe a sharded minimal perfect hash over line hashes.

Long enough lines are hashed to 128 bits, once per document. All distinct hashes are the keys of the
index. They are dealt to shards by their first half. Each shard holds a minimal perfect hash (levels of bit
arrays, a key's place being the rank of its bit) and compact arrays in that order: the second half of the hash
as fingerprint, and the number of documents in four bytes, larger numbers as the largest. A third array holds the
document that keeps the line, only for lines of enough documents; its place is the rank among those. Line
hashes of documents go to their shard and probe the arrays, whose counts decide; only lines to drop come back.
Texts are never joined by line.

A line that very many documents share sends them all to one shard. The counts tell how many probes
a shard will get, so the arrays of shards with many are copied and their probes are dealt to the copies at random.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldex.llm.common import WHITE, row_key, utf8, written

GAMMA = 2.0
SHARD_KEYS = 50_000
PROBES = 1_000_000
#: The largest count of the count arrays; stands for all larger ones.
COUNTED = 2**32 - 1
#: Stands for a null id, below all others.
NO_ID = -2**63


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A hash of unsigned 64-bit keys for a level."""
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The bits of all levels, one after another, and the levels' sizes, for distinct keys.

    On a level every remaining key points at a bit; keys alone at theirs have found their place, the
    others go to the next level. A key's place is the rank of its bit among all set bits.
    """
    bits, sizes = [], []
    while len(keys):
        size = max(64, int(GAMMA * len(keys)))
        at = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        bits.append(alone)
        sizes.append(size)
        keys = keys[~alone[at]]
    return (np.concatenate(bits) if bits else np.zeros(0, bool)), sizes


def places(bits: np.ndarray, sizes: list[int], keys: np.ndarray) -> np.ndarray:
    """The place of each key; -1 for some of the keys that are not in the hash."""
    rank = np.cumsum(bits) - 1
    out = np.full(len(keys), -1, np.int64)
    left, start = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = start + (mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
        hit = bits[at]
        out[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + size
    return out


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 16-byte hash of a line's key; nothing for short lines."""
    key = line.strip(WHITE.encode()).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per document and distinct line."""
        for batch in batches:
            at, found = [], []
            for i, text in enumerate(utf8(batch.column("text"))):
                keys = {k for line in (text or b"").split(b"\n") if (k := line_key(line, min_chars))}
                at += [i] * len(keys)
                found += keys
            halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column("row").take(at), batch.column("doc_id").take(at),
                pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["row", "doc_id", "hash", "print"])
    return run


def build_shard(min_docs: int):
    def run(table: pa.Table) -> pa.Table:
        """One row with a shard's index."""
        keys = table.column("hash").to_numpy().view(np.uint64)
        # Keys that share 64 of their 128 bits cannot share a place; the later ones go beside the hash.
        first = np.zeros(len(keys), bool)
        first[np.unique(keys, return_index=True)[1]] = True
        bits, sizes = build_hash(keys[first])
        order = np.concatenate([np.flatnonzero(first)[np.argsort(places(bits, sizes, keys[first]))], np.flatnonzero(~first)])
        counts = np.minimum(table.column("n").to_numpy()[order], COUNTED).astype(np.uint32)
        keepers = table.column("keeper").fill_null(NO_ID).to_numpy()[order]
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "extra": pa.array([keys[~first].tobytes()], pa.binary()),
            "prints": pa.array([table.column("print").to_numpy()[order].tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()),
            "keepers": pa.array([keepers[counts >= min_docs].tobytes()], pa.binary()),
        })
    return run


def probe(min_docs: int):
    def run(probes: pa.Table, index: pa.Table) -> pa.Table:
        """The probes whose line goes: enough documents hold it and the document is not its keeper."""
        if not index.num_rows or not probes.num_rows:
            return probes.select(["row", "hash"]).slice(0, 0)
        shard = index.to_pylist()[0]
        sizes = shard["sizes"]
        bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=sum(sizes)).astype(bool)
        prints, keepers = (np.frombuffer(shard[c], np.int64) for c in ("prints", "keepers"))
        frequent = np.frombuffer(shard["counts"], np.uint32) >= min_docs
        keys = probes.column("hash").to_numpy().view(np.uint64)
        own, doc = probes.column("print").to_numpy(), probes.column("doc_id").fill_null(NO_ID).to_numpy()
        at = places(bits, sizes, keys)
        found = (at >= 0) & (prints[at] == own)
        extra = np.frombuffer(shard["extra"], np.uint64)
        for i, key in enumerate(extra, len(prints) - len(extra)):
            same = (keys == key) & (prints[i] == own)
            at[same], found = i, found | same
        hit = np.flatnonzero(found & frequent[at])
        rank = np.cumsum(frequent) - 1
        gone = hit[keepers[rank[at[hit]]] != doc[hit]]
        return probes.select(["row", "hash"]).take(pa.array(gone))
    return run


def kept_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts without the lines whose hashes are in ``gone``."""
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(utf8(batch.column("text")), batch.column("gone").to_pylist()):
                lines = (text or b"").split(b"\n")
                kept = lines
                if gone:
                    out = {g.to_bytes(8, "little", signed=True) for g in gone}
                    kept = [x for x in lines if not ((k := line_key(x, min_chars)) and k[:8] in out)]
                texts.append(b"\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ], ["doc", "kept", "n_lines", "n_dropped", "kept_sha256"])
    return run


def dropped_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(row, gone): per document with lines to drop, its row key and the first halves of their hashes."""
    narrow = docs.select(row_key("doc_id", "text").alias("row"), F.col("doc_id").cast("bigint"), "text")
    lines = written(narrow.mapInArrow(line_hashes(min_chars), "row long, doc_id long, hash long, print long"), "lines")
    keys = lines.groupBy("hash", "print").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    keys = written(keys, "line-keys")

    size = keys.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("probes")).first()
    shards = max(64, size["keys"] // SHARD_KEYS)
    shard = F.pmod("hash", F.lit(shards)).cast("int")
    index = keys.withColumn("shard", shard).groupBy("shard").applyInArrow(
        build_shard(min_docs), "shard int, bits binary, sizes array<long>, extra binary, prints binary, counts binary, keepers binary")
    # A shard gets as many probes as its keys have documents. Only shards with more than twice their even share, or with more than
    # PROBES, are copied, so what is broadcast has one row of two integers for each of at most shards / 2 such shards,
    # and for each task's worth of probes.
    copies = F.ceil(F.sum("n") / max(1.0, min(PROBES, 2 * size["probes"] / shards))).cast("int")
    hot = written(keys.groupBy(shard.alias("shard")).agg(copies.alias("copies")).where("copies > 1"), "line-shards")
    copy = F.coalesce(F.pmod(F.xxhash64("row", "hash"), "copies").cast("int"), F.lit(0))
    probes = lines.withColumn("shard", shard).join(F.broadcast(hot), "shard", "left").select(
        *lines.columns, "shard", copy.alias("copy"))
    dealt = index.join(F.broadcast(hot), "shard", "left").select(
        *index.columns, F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"))
    hits = probes.groupBy("shard", "copy").cogroup(dealt.groupBy("shard", "copy")).applyInArrow(
        probe(min_docs), "row long, hash long")
    # At most the distinct lines of one document.
    return hits.groupBy("row").agg(F.collect_set("hash").alias("gone"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per document: ``doc`` (its columns but the text), kept text, n_lines, n_dropped, kept_sha256.

    A line's key is the line without white space at its ends, A to Z lower-cased. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` documents lose all their lines but those of
    the largest doc_id. Null or empty text is one empty line. Each row counts as a document, repeated
    rows too; rows that share the largest doc_id all keep the line. A null doc_id is below all others.
    """
    gone = dropped_lines(docs, min_chars, min_docs)
    others = [c for c in docs.columns if c != "text"]
    doc = F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0).alias("none")]).alias("doc")
    joined = docs.select(doc, row_key("doc_id", "text").alias("row"), "text").join(gone, "row", "left").drop("row")
    kept = joined.select("doc").schema.add("kept", "string").add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(kept_lines(min_chars), kept.add("kept_sha256", "string"))


def without_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with their texts less the repeated lines; ``n_chars`` follows where it is a column."""
    kept = dedup_lines(docs, min_chars, min_docs)
    def column(name: str):
        if name == "text":
            return F.col("kept").alias("text")
        if name == "n_chars":
            return F.char_length("kept").cast(docs.schema["n_chars"].dataType).alias("n_chars")
        return F.col(f"doc.`{name}`").alias(name)
    return kept.select(*[column(c) for c in docs.columns])
