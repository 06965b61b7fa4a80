"""Rebuild and backfill of collections from snapshots, and user-defined actions."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.model import DELETE, INSERT, NAMESPACE, ApplyPolicy, IndexConfig
from foldex.operators.project import payload_columns, project
from foldex.operators.read import with_tokens
from foldex.plans import files
from foldex.plans.store import Commit, IndexStore
from foldex.sources.snapshot import document_upserts, scan_collections

Action = Callable[[IndexStore], object]


def keyed(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("uid").isNotNull() & (F.col("uid") != ""))


def snapshot_rejects(documents: DataFrame, as_of: int) -> DataFrame:
    """The documents of a snapshot that have no key."""
    unkeyed = documents.where(F.col("uid").isNull() | (F.col("uid") == ""))
    return unkeyed.select(F.lit(as_of).cast("bigint").alias("seq"), F.lit(INSERT).alias("op"), *NAMESPACE, "uid",
                          F.lit("missing_key").alias("reason"))


def snapshot_rows(documents: DataFrame, config: IndexConfig, policy: ApplyPolicy, as_of: int,
                  collections: Sequence[str] = ()) -> DataFrame:
    """Index rows of snapshot documents, one per document key.

    Keys are unique in a collection, so nothing is shuffled unless collections share the keys of an
    index: then the one that is written last wins, in the order of ``collections`` or else of their names.
    """
    rows = project(keyed(documents), config, policy)
    rows = (with_tokens(rows, config) if config.store_tokens else rows).withColumn("seq", F.lit(as_of).cast("bigint"))
    if policy.key == "namespace":
        return rows
    place = F.array_position(F.array(*[F.lit(c) for c in collections]).cast("array<string>"), F.col("collection"))
    last = W.partitionBy(*policy.key_columns).orderBy(place.desc(), F.col("collection").desc(), F.col("database").desc())
    return rows.withColumn("_nth", F.row_number().over(last)).where("_nth = 1").drop("_nth")


def reindex_rows(current: DataFrame, documents: DataFrame, collections: Sequence[str], config: IndexConfig,
                 policy: ApplyPolicy, as_of: int, databases: str | Sequence[str]) -> DataFrame:
    """Index rows after clearing the collections of exactly these databases and indexing their documents again.

    Other namespaces pass through untouched; neither side is shuffled unless namespaces share keys.
    """
    names, cleared = list(collections), _cleared(collections, databases)
    fresh = snapshot_rows(scan_collections(documents, names).where(cleared), config, policy, as_of, names)
    rest = current.where(~F.coalesce(cleared, F.lit(False)))
    if policy.key == "index":
        keys = list(policy.key_columns)
        rest = rest.join(fresh.select(*keys), keys, "left_anti")
    return rest.select(fresh.columns).unionByName(fresh)


def _cleared(collections: Sequence[str], databases: str | Sequence[str]) -> Column:
    databases = [databases] if isinstance(databases, str) else list(databases)
    return F.col("collection").isin(list(collections)) & F.col("database").isin(databases)


def backfill_rows(current: DataFrame, documents: DataFrame, config: IndexConfig, policy: ApplyPolicy,
                  as_of: int) -> DataFrame:
    """Index rows after upserting all documents without clearing first.

    Keys are unique among the fresh rows, so only the keys of both sides meet in one anti join.
    """
    fresh = snapshot_rows(documents, config, policy, as_of)
    keys = list(policy.key_columns)
    kept = current.join(fresh.select(*keys), keys, "left_anti")
    return kept.select(fresh.columns).unionByName(fresh)


def _routes(store: IndexStore, namespaces: DataFrame) -> set[str]:
    """The indices of some namespaces: one row per index."""
    name = store.config.route(F.col("database"), F.col("collection")).alias("index_name")
    return {r.index_name for r in namespaces.select(name).distinct().collect()}


class RebuildMetrics:
    """What a rebuild reads, indexes and leaves out per collection, observed while it runs: no pass of its own."""

    def __init__(self, collections: Sequence[str]):
        self.collections = list(collections)
        self.observation = Observation(f"rebuild-{uuid.uuid4().hex}")

    def on(self, documents: DataFrame) -> DataFrame:
        """``documents``, counted as they pass."""
        keyless = F.col("uid").isNull() | (F.col("uid") == "")
        own = [F.coalesce(F.col("collection") == c, F.lit(False)) for c in self.collections]
        counts = [F.count_if(c & k).alias(f"{n}{i}") for i, c in enumerate(own) for n, k in (("n_indexed", ~keyless), ("n_rejected", keyless))]
        return documents.observe(self.observation, *counts)

    def rows(self) -> list[tuple[str, int, int, int]]:
        """(collection, n_read, n_indexed, n_rejected), when the rebuild has ended."""
        found = self.observation.get
        pairs = [(c, found[f"n_indexed{i}"], found[f"n_rejected{i}"]) for i, c in enumerate(self.collections)]
        return [(c, indexed + rejected, indexed, rejected) for c, indexed, rejected in pairs]


def reindex(documents: DataFrame, collections: Sequence[str], databases: str | Sequence[str],
            metrics: RebuildMetrics | None = None) -> Action:
    """Action: rebuild collections of the given databases. What the log holds is taken before the scan
    starts, so events that arrive during the scan are folded on top of it."""

    def run(store: IndexStore) -> Commit:
        cut = store.cut()
        touched = store.touched(cut)
        wanted = scan_collections(documents, list(collections)).where(_cleared(collections, databases))
        counted = wanted if metrics is None else metrics.on(wanted)
        rows = reindex_rows(store.rows(cut), counted, collections, store.config, store.policy, cut.as_of, databases)
        own = scan_collections(documents, list(collections)).where(_cleared(collections, databases))
        asked = [(d, c) for d in ([databases] if isinstance(databases, str) else databases) for c in collections]
        routes = _routes(store, store.spark.createDataFrame(asked, "database string, collection string"))
        return store.commit(rows, cut, "reindex", None if touched is None else touched | routes,
                            snapshot_rejects(own, cut.as_of))

    return run


def content(rows: DataFrame) -> Column:
    """A digest of an index row's fields, the same for the same content."""
    def value(field: T.StructField) -> Column:
        return F.array_sort(F.map_entries(field.name)) if isinstance(field.dataType, T.MapType) else F.col(field.name)

    fields = [rows.schema[c] for c in sorted(payload_columns(rows))]
    return F.md5(F.to_json(F.struct(*[value(f).alias(f.name) for f in fields]), {"ignoreNullFields": "false"}))


def reindex_changed(documents: DataFrame, collections: Sequence[str], databases: str | Sequence[str]) -> Action:
    """Action: rebuild collections by writing only what differs. Returns the name of the batch, none if nothing differs.

    Every document is read and projected, but only keys and digests are shuffled. Documents that are new or differ are indexed
    and those that the source has no more are deleted, as one batch of the log; bases stay as they are until the next
    compaction. The store's keys must be its namespaces', and ids unique in a collection.
    """

    def run(store: IndexStore) -> str | None:
        if store.policy.key != "namespace":
            raise ValueError("only keys of namespaces can be compared one by one")
        cut, keys = store.cut(), [*NAMESPACE, "uid"]
        wanted = keyed(scan_collections(documents, list(collections)).where(_cleared(collections, databases)))
        fresh = snapshot_rows(wanted, store.config, store.policy, cut.as_of)
        current = store.rows(cut).where(_cleared(collections, databases))
        both = current.select(*keys, content(current).alias("old")).join(fresh.select(*keys, content(fresh).alias("new")), keys, "full_outer")
        draft = f"{store.root}/drafts/{uuid.uuid4().hex}"
        try:
            both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, F.col("new").isNull().alias("gone")).write.parquet(draft)
            differing = store.spark.read.schema("database string, collection string, uid string, gone boolean").parquet(draft)
            if differing.isEmpty():
                return None
            changed = document_upserts(wanted.join(differing.where("not gone"), keys, "left_semi"), cut.as_of)
            gone = differing.where("gone").select(F.lit(cut.as_of).cast("bigint").alias("seq"), F.lit(DELETE).alias("op"), *keys,
                                                  F.lit(None).cast(changed.schema["doc"].dataType).alias("doc"))
            return store.append(changed.select(gone.columns).unionByName(gone), nth=max(cut.nth + 1, time.time_ns()))
        finally:
            files.remove(store.spark, draft)

    return run


def backfill(documents: DataFrame) -> Action:
    """Action: upsert all documents of a snapshot into the index."""

    def run(store: IndexStore) -> Commit:
        cut = store.cut()
        touched = store.touched(cut)
        rows = backfill_rows(store.rows(cut), documents, store.config, store.policy, cut.as_of)
        indices = None if touched is None else touched | _routes(store, documents.select(*NAMESPACE))
        return store.commit(rows, cut, "backfill", indices, snapshot_rejects(documents, cut.as_of))

    return run
