"""Counts of a store, kept up with its versions: documents per collection and per facet value.

A version of the store differs from the one before in the documents that its log names. Their images before count -1, their
images after +1, and the sums are a segment of the counts table; reading adds segments up and opens neither bases nor log.
``segments/`` holds the sums, ``commits/`` one small file per version that names them. When there are many segments they
are merged; after a commit that the log does not tell of (a rebuild, a clear, a user's action), all documents are counted once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldex.model import EXT
from foldex.operators.read import METADATA, IndexView
from foldex.plans import files
from foldex.plans.store import IndexStore

OF = ("index_name", "_database", "_collection")
COUNTS = "index_name string, _database string, _collection string, dim string, value string, n bigint"


@dataclass(frozen=True)
class Counted:
    """A version of the counts: the version of the store they cover and their segments."""

    version: int = 0
    store_version: int = 0
    segments: tuple[str, ...] = ()


class MaintainedCounts:
    """Sizes and facet counts of the newest version of ``store`` that ``refresh`` has seen."""

    def __init__(self, store: IndexStore, max_segments: int = 16):
        self.store = store
        self.spark = store.spark
        self.root = f"{store.root}/counts"
        self.max_segments = max_segments

    def head(self) -> Counted:
        names = [n for n in files.names(self.spark, f"{self.root}/commits") if n.endswith(".json")]
        if not names:
            return Counted()
        found = json.loads(files.read_text(self.spark, f"{self.root}/commits/{names[-1]}"))
        return Counted(**found | {"segments": tuple(found["segments"])})

    def refresh(self) -> Counted:
        """Brings the counts up to the store's newest version; counts only what the log names, if it can."""
        head, newest = self.head(), self.store.head().version
        if head.store_version == newest:
            return head
        name, segments, rows = uuid.uuid4().hex, (), None
        # One row per version that is kept.
        if head.store_version and head.store_version in {r.version for r in self.store.history().select("version").collect()}:
            rows = self._changed(head.store_version, newest)
        if rows is None:
            rows = self._signed(self.store.version(newest).documents.select(*METADATA, *self._columns(newest)), 1)
        elif len(head.segments) < self.max_segments:
            segments = head.segments
        else:
            rows = rows.unionByName(self._rows(head))
        self._summed(rows).write.parquet(f"{self.root}/segments/{name}")
        record = Counted(head.version + 1, newest, (*segments, name))
        if not files.publish(self.spark, f"{self.root}/commits/{record.version:020d}.json", json.dumps(asdict(record))):
            raise RuntimeError("the counts were refreshed by someone else meanwhile")
        return record

    def vacuum(self) -> None:
        """Removes the segments and versions that the newest version does not name; readers of older ones must have ended."""
        head = self.head()
        for name in files.complete(self.spark, f"{self.root}/segments"):
            if name not in head.segments:
                files.remove(self.spark, f"{self.root}/segments/{name}")
        for name in files.names(self.spark, f"{self.root}/commits"):
            if name != f"{head.version:020d}.json":
                files.remove(self.spark, f"{self.root}/commits/{name}")

    # -- counting ---------------------------------------------------------------------------------

    def _columns(self, version: int) -> list[str]:
        """The fields that facets come from; no others are read."""
        config = self.store.config
        facets = {*config.facets, *[d for ds in config.facets_by_index.values() for d in ds]}
        return [c for c in self.store.version(version).documents.columns if c in {*facets, EXT} and facets and c not in METADATA]

    def _changed(self, old: int, new: int) -> DataFrame | None:
        found = self.store.altered(old, new, self._columns(new))
        if found is None:
            return None
        before, after = found
        return self._signed(before, -1).unionByName(self._signed(after, 1))

    def _signed(self, documents: DataFrame, sign: int) -> DataFrame:
        """A row per document and one per facet value it has, without a dimension for the document itself."""
        none, n = F.lit(None).cast("string"), F.lit(sign).cast("bigint").alias("n")
        rows = documents.select(*OF, none.alias("dim"), none.alias("value"), n)
        if not (self.store.config.facets or self.store.config.facets_by_index):
            return rows
        return rows.unionByName(IndexView(documents, self.store.config).facet_rows(OF).select(*OF, "dim", "value", n))

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        """Sums combine on the map side, so a large collection is one row per task."""
        return rows.groupBy(*OF, "dim", "value").agg(F.sum("n").alias("n")).where("n <> 0")

    def _rows(self, head: Counted) -> DataFrame:
        if not head.segments:
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(*[f"{self.root}/segments/{s}" for s in head.segments])

    # -- reading ----------------------------------------------------------------------------------

    def _total(self, rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum("n").alias("n")).where("n <> 0")

    def sizes(self) -> DataFrame:
        """Number of documents of every collection."""
        return self._total(self._rows(self.head()).where("dim is null"), "_database", "_collection")

    def index_counts(self) -> DataFrame:
        """Number of documents of every index, across collections."""
        return self._total(self._rows(self.head()).where("dim is null"), "index_name")

    def size(self, database: str, collection: str) -> int:
        """Number of documents of one collection."""
        mine = self.sizes().where((F.col("_database") == database) & (F.col("_collection") == collection)).first()
        return mine.n if mine else 0

    def facets(self, index: str | None = None, collection: str | None = None) -> DataFrame:
        """Documents per facet value, of one index or collection or of all."""
        rows = self._rows(self.head()).where("dim is not null")
        rows = rows if index is None else rows.where(F.col("index_name") == index)
        rows = rows if collection is None else rows.where(F.col("_collection") == collection)
        return self._total(rows, "dim", "value")
