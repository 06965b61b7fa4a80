"""Inverted index of a store: postings that are written once and kept up, so that term queries read no texts.

``documents/`` (document number → key), ``blocks/`` (term → documents) and ``dead/`` (numbers that no longer count) have one
folder per segment; ``commits/`` names the segments of each version. A block holds documents of one term among
65,536 document numbers in a row, as distances from the first number, with term frequencies; it comes from one task, and blocks
of several tasks may share a range. So a term that every document has is many blocks, and no row grows with the corpus. Blocks are written in buckets of terms, in order of terms, with a bloom
filter on the term: a query opens the files of its buckets and reads the row groups that may hold its terms.

A segment covers what changed between two versions of the store. Changed and deleted documents are marked dead in older
segments; when there are many segments, one is written afresh from all documents.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldex.functions.blocks import PIECES, block_pieces
from foldex.functions.sizing import fits_broadcast
from foldex.operators.read import METADATA, IndexView
from foldex.plans import files
from foldex.plans.store import IndexStore

#: Document numbers that one block covers, as a power of two.
BLOCK_BITS = 16
#: Changed documents up to which hashes of their keys, one long each, are broadcast before texts move.
HASHES = 1 << 20
FACET = "facet:"
NUMBER = ("segment", "doc_no")
DOCUMENTS = "doc_no bigint, index_name string, _id string, _collection string, _database string, segment string"
BLOCKS = ("index_name string, term string, block bigint, n bigint, offsets array<int>, tfs array<int>,"
          " segment string, field string, bucket int")
DEAD = "dead_segment string, dead_no bigint, segment string"


@dataclass(frozen=True)
class Segments:
    """A version of the inverted index: the version of the store it covers and its segments, oldest first."""

    version: int = 0
    store_version: int = 0
    segments: tuple[str, ...] = ()


class InvertedIndex:
    """The inverted index of ``store`` over ``fields`` (its text fields by default) and its facets."""

    def __init__(self, store: IndexStore, fields: Sequence[str] | None = None, buckets: int = 32, max_segments: int = 8):
        self.store = store
        self.spark = store.spark
        self.config = store.config
        self.fields = list(store.config.text_fields() if fields is None else fields)
        self.root = f"{store.root}/postings"
        self.buckets = buckets
        self.max_segments = max_segments

    # -- versions -------------------------------------------------------------------------------

    def head(self) -> Segments:
        names = [n for n in files.names(self.spark, f"{self.root}/commits") if n.endswith(".json")]
        if not names:
            return Segments()
        found = json.loads(files.read_text(self.spark, f"{self.root}/commits/{names[-1]}"))
        return Segments(**found | {"segments": tuple(found["segments"])})

    def refresh(self) -> Segments:
        """Brings the index up to the store's newest version; reads only documents that the log names, if it can."""
        head, newest = self.head(), self.store.head()
        if not newest.version or head.store_version == newest.version:
            return head
        name = uuid.uuid4().hex
        kept = {r.version for r in self.store.history().select("version").collect()}  # one row per version kept
        draft = f"{self.root}/drafts/{name}"
        try:
            if head.segments and head.store_version in kept and len(head.segments) < self.max_segments:
                found = self._changed(head, newest.version, name, draft)
                segments = (*head.segments, name)
            else:
                found, segments = self.store.version(newest.version).documents, (name,)
            self._write(found, name, draft)
        finally:
            files.remove(self.spark, draft)
        record = Segments(head.version + 1, newest.version, segments)
        if not files.publish(self.spark, f"{self.root}/commits/{record.version:020d}.json", json.dumps(asdict(record))):
            raise RuntimeError("the inverted index was refreshed by someone else meanwhile")
        return record

    def vacuum(self) -> None:
        """Removes the segments and versions that the newest version does not name; readers of older ones must have ended."""
        head = self.head()
        for kind in ("documents", "blocks", "dead"):
            for name in files.complete(self.spark, f"{self.root}/{kind}"):
                if name.removeprefix("segment=") not in head.segments:
                    files.remove(self.spark, f"{self.root}/{kind}/{name}")
        for name in files.names(self.spark, f"{self.root}/commits"):
            if name != f"{head.version:020d}.json":
                files.remove(self.spark, f"{self.root}/commits/{name}")

    # -- writing ----------------------------------------------------------------------------------

    def _columns(self, documents: DataFrame) -> list[str]:
        """The fields that the postings come from: indexed fields, what is analysed of them, and facet dimensions."""
        facets = {*self.config.facets, *[d for ds in self.config.facets_by_index.values() for d in ds]}
        named = {*self.fields, *[f"{f}_tokens" for f in self.fields], *facets, "ext"}
        return [c for c in documents.columns if c in named and c not in METADATA]

    def _changed(self, head: Segments, version: int, name: str, draft: str) -> DataFrame:
        """Marks what changed since as dead and returns the documents as they are now."""
        now = self.store.version(version).documents
        actions = self.store.changes(head.store_version, version, self._columns(now), digests=True)
        keys = {"index_name": "index_name", "uid": "_id", "collection": "_collection", "database": "_database"}
        actions.select(*[F.col(a).alias(b) for a, b in keys.items()], "action").write.parquet(f"{draft}/changed")
        changed = self.spark.read.parquet(f"{draft}/changed")
        gone = self.documents(head).join(changed.where("action <> 'index'").select(*METADATA), list(METADATA), "left_semi")
        gone.select(F.col("segment").alias("dead_segment"), F.col("doc_no").alias("dead_no")).write.parquet(f"{self.root}/dead/segment={name}")
        wanted = changed.where("action <> 'delete'").select(*METADATA)
        hashes = wanted.select(F.xxhash64(*METADATA).alias("_hash")).distinct()
        if fits_broadcast(hashes, HASHES):
            # Texts of nearly all other documents stay where they are; the join on keys decides.
            now = now.join(F.broadcast(hashes), F.xxhash64(*METADATA) == F.col("_hash"), "left_semi")
        return now.join(wanted, list(METADATA), "left_semi")

    def _write(self, documents: DataFrame, name: str, draft: str) -> None:
        """Numbers the documents, written aside once so that numbers stay, and writes their blocks."""
        numbered = documents.select(*METADATA, *self._columns(documents), F.monotonically_increasing_id().alias("doc_no"))
        numbered.write.parquet(f"{draft}/documents")
        numbered = self.spark.read.schema(numbered.schema).parquet(f"{draft}/documents")
        keys = numbered.select("doc_no", *METADATA).sortWithinPartitions("doc_no")
        keys.write.option("parquet.bloom.filter.enabled#_id", "true").parquet(f"{self.root}/documents/segment={name}")
        view = IndexView(numbered, self.config)
        found = [(f, view.tokens(f)) for f in self.fields] + [(FACET + d, v) for d, v in view.facet_values()]
        tokens = [v.cast("array<string>").alias(f"tokens_{k}") for k, (_, v) in enumerate(found)]
        pieces = numbered.select("doc_no", "index_name", *tokens).mapInArrow(block_pieces([n for n, _ in found], BLOCK_BITS), PIECES)
        pieces = pieces.withColumn("bucket", self._bucket(F.col("term"))).hint("rebalance", "field", "bucket")
        pieces = pieces.sortWithinPartitions("field", "bucket", "term", "index_name", "block")
        number = lambda o: o.cast("int").bitwiseAND(F.lit(0xFFFF))
        tfs = F.coalesce("large", F.transform("tfs", lambda t: t.cast("int")))
        out = pieces.select("index_name", "term", "block", F.size("offsets").cast("bigint").alias("n"),
                            F.transform("offsets", number).alias("offsets"), tfs.alias("tfs"), "field", "bucket")
        out.write.option("parquet.bloom.filter.enabled#term", "true").partitionBy("field", "bucket").parquet(f"{self.root}/blocks/segment={name}")

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    # -- reading ------------------------------------------------------------------------------------

    def _read(self, kind: str, schema: str, segments: Sequence[str]) -> DataFrame:
        """The rows of some segments; one without rows has no files to read."""
        there = set(files.complete(self.spark, f"{self.root}/{kind}"))
        paths = [f"{self.root}/{kind}/segment={s}" for s in segments if f"segment={s}" in there]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*paths)

    def _live(self, rows: DataFrame, head: Segments) -> DataFrame:
        """Rows with a document number, without those that are dead; a single segment has none."""
        if len(head.segments) < 2:
            return rows
        dead = self._read("dead", DEAD, head.segments[1:]).select("dead_segment", "dead_no")
        dead = F.broadcast(dead) if fits_broadcast(dead) else dead
        return rows.join(dead, (F.col("segment") == F.col("dead_segment")) & (F.col("doc_no") == F.col("dead_no")), "left_anti")

    def documents(self, head: Segments | None = None) -> DataFrame:
        """Number and key of every document."""
        head = head or self.head()
        return self._live(self._read("documents", DOCUMENTS, head.segments), head)

    def blocks(self, head: Segments | None = None) -> DataFrame:
        return self._read("blocks", BLOCKS, (head or self.head()).segments)

    @staticmethod
    def _numbers(blocks: DataFrame, *carry: str) -> DataFrame:
        entries = F.arrays_zip("offsets", "tfs")
        rows = blocks.select("segment", "block", *carry, F.explode(entries).alias("e"))
        return rows.select("segment", (F.shiftleft("block", BLOCK_BITS) + F.col("e.offsets")).alias("doc_no"), *carry, F.col("e.tfs").alias("tf"))

    def _hits(self, field: str, terms: dict[str | None, Sequence[str]], head: Segments) -> DataFrame:
        """Numbers of documents, dead ones too, with one of the terms; terms may differ for single indices (None: all others)."""
        every = sorted({t for ts in terms.values() for t in ts})
        if not every:
            return self.spark.createDataFrame([], "segment string, doc_no bigint")
        blocks = self.blocks(head).where((F.col("field") == field) & F.col("term").isin(every))
        blocks = blocks.where(reduce(or_, [F.col("bucket") == self._bucket(F.lit(t)) for t in every]))
        if len(terms) > 1:
            own = [i for i in terms if i is not None]
            rules = [(F.col("index_name") == i) & F.col("term").isin(list(terms[i])) for i in own]
            blocks = blocks.where(reduce(or_, rules, ~F.col("index_name").isin(own) & F.col("term").isin(list(terms.get(None, ())))))
        found = self._numbers(blocks).select(*NUMBER)
        return found.distinct() if len(every) > 1 else found

    def _term_hits(self, field: str, value: str, head: Segments) -> DataFrame:
        name = field if field in self.fields else FACET + field
        return self._hits(name, {None: [str(value)]}, head)

    def _match_hits(self, field: str, text: str, head: Segments) -> DataFrame:
        analyzers = {None: self.config.analyzer, **self.config.analyzers}
        # The words of the query text: one row, of one array for each analyser.
        words = self.spark.range(1).select(*[a.for_field(field).tokens(F.lit(text)) for a in analyzers.values()]).first()
        return self._hits(field, dict(zip(analyzers, words)), head)

    def _keys(self, hits: DataFrame, head: Segments) -> DataFrame:
        return self.documents(head).join(hits, list(NUMBER), "left_semi").select(*METADATA)

    def term(self, field: str, value: str) -> DataFrame:
        """Keys of the documents with an exact term in an indexed field, or a value in a facet dimension."""
        head = self.head()
        return self._keys(self._term_hits(field, value, head), head)

    def match(self, field: str, text: str) -> DataFrame:
        """Keys of the documents that share a word with ``text``, analysed as each index analyses."""
        head = self.head()
        return self._keys(self._match_hits(field, text, head), head)

    def postings(self, field: str) -> DataFrame:
        """Term → document with term frequency, from the blocks."""
        head = self.head()
        # Numbers that are dead have no key here. A place in the list of segments is shorter than a segment's name.
        place = lambda df: df.withColumn("segment", F.array_position(F.lit(list(head.segments)), F.col("segment")).cast("int"))
        rows = place(self._numbers(self.blocks(head).where(F.col("field") == field), "term"))
        # Numbers are unique and spread evenly over tasks, so those of one task are hashed and its postings need no sort.
        return rows.join(place(self.documents(head)).hint("shuffle_hash"), list(NUMBER)).select("term", *METADATA, F.col("tf").cast("bigint"))

    def facets(self, among: dict[str, str] | None = None) -> DataFrame:
        """Documents per facet value; with ``among`` only of those that have all these terms (field → term).

        Without conditions and dead documents the counts of blocks are added up, and no block is opened.
        """
        head = self.head()
        blocks = self.blocks(head).where(F.col("field").startswith(FACET))
        named = [F.substring("field", len(FACET) + 1, 1_000_000).alias("dim"), F.col("term").alias("value")]
        if not among and len(head.segments) < 2:
            return blocks.groupBy(*named).agg(F.sum("n").alias("n"))
        rows = self._live(self._numbers(blocks, "field", "term"), head)
        for field, value in (among or {}).items():
            rows = rows.join(self._term_hits(field, value, head), list(NUMBER), "left_semi")
        return rows.groupBy(*named).agg(F.count(F.lit(1)).alias("n"))
