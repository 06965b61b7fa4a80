"""Versioned index store on a shared file system.

``log/``      one folder per batch of change rows, partitioned by index; drop events in one control partition
``bases/``    complete rows of single indices, in folders that versions share
``rejects/``  changes that compactions left out, with the reason
``drops/``    drop events that changes may still come below of, where late changes are folded
``commits/``  one small file per version: its bases, and by name the batches folded into them

A batch is there once its folder is complete, a version once its file is; the file's name can be published only
once. The current index is the newest version with the batches it does not name folded on top, so a
batch that lands after a compaction began is never mistaken for part of it.

Changes are ordered by ``seq``; documents indexed outside the feed come after the feed's head without using up
its next number: they share the head's ``seq`` and are told apart by ``nth``.

Changes below a version are rejected as late, or folded exactly: with ``late``, bases hold document states (``operators.states``),
dead ones too, and a compaction accepts whatever lies at most ``late`` below its last ``seq``. Any other commit (a rebuild,
a clear, a user's action) closes the past: what lies below it is late.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.functions.sizing import BROADCAST_ROWS, fits_broadcast
from foldex.model import CHANGE_COLUMNS, CONTROL_OPS, DROP, DROP_DATABASE, NAMESPACE, STATE_COLUMNS, ApplyPolicy, IndexConfig
from foldex.operators import states as S
from foldex.operators.barriers import Barrier, barriers, drop_events
from foldex.operators.export import actions, document_key, narrowed
from foldex.operators.fold import apply_changes
from foldex.operators.project import index_documents, payload_columns, project
from foldex.operators.read import METADATA, IndexView, with_tokens
from foldex.operators.rejects import document_reason, row_reason, sequence_conflicts, updates_without_target
from foldex.plans import files
from foldex.sources.snapshot import document_upserts

CONTROL = "__control"
BEFORE_ALL = -1
REJECT_SCHEMA = "seq bigint, op string, database string, collection string, uid string, reason string"
#: How the names of batches from outside the feed end.
UPSERT = "-upsert"
#: Room for ``nth`` below each ``seq``.
NTH = 10**19
ORDER = S.ORDER
DROPS = T.StructType([*[T.StructField(c, T.StringType()) for c in ("op", *NAMESPACE)], T.StructField("seq", ORDER)])


@dataclass(frozen=True)
class Commit:
    """A version: the last change it covers, a base folder per index, the batches folded into them.

    Where late changes are folded, ``floor`` is the order number from which they are accepted, and ``drops`` names a folder.
    """

    version: int = 0
    as_of_seq: int = BEFORE_ALL
    as_of_nth: int = 0
    bases: dict[str, str] = field(default_factory=dict)
    batches: tuple[str, ...] = ()
    rejects: tuple[str, ...] = ()
    reason: str = "empty"
    floor: int | None = None
    drops: str = ""


@dataclass(frozen=True)
class Cut:
    """The batches to fold above a version, and the last change among them."""

    as_of: int
    nth: int
    batches: tuple[str, ...]
    head: Commit


class IndexStore:
    """An index under ``root``; ``doc_type`` is the type of the change rows' ``doc`` column.

    ``late`` is how far below the last ``seq`` of a compaction changes may still come; without it none may. Whether it is
    set is decided with a store's first version; how far may change.
    """

    def __init__(self, spark: SparkSession, root: str, config: IndexConfig, doc_type: T.DataType,
                 policy: ApplyPolicy | None = None, broadcast_rows: int = BROADCAST_ROWS, late: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.config = config
        self.policy = policy or ApplyPolicy()
        self.doc_type = doc_type
        self.broadcast_rows = broadcast_rows
        self.late = late
        if late is not None:
            S.check_policy(self.policy, config.extender is not None)
        self.log_schema = self._log_schema()

    # -- layout ---------------------------------------------------------------------------

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    @property
    def commit_path(self) -> str:
        return f"{self.root}/commits"

    def _log_schema(self) -> T.StructType:
        template = T.StructType([
            T.StructField("seq", T.LongType()),
            *[T.StructField(c, T.StringType()) for c in ("op", *NAMESPACE, "uid")],
            T.StructField("doc", self.doc_type),
        ])
        rows = self.log_rows(self.spark.createDataFrame([], template))
        return T.StructType([*rows.schema.fields, T.StructField("batch", T.StringType())])

    def log_rows(self, changes: DataFrame, nth: int = 0) -> DataFrame:
        """Change rows in log form: projected first, so whole documents are never stored or moved.

        ``reject`` says why a row cannot be applied; it is known before the fold, so a broken change
        never replaces a good document.
        """
        reason = F.coalesce(row_reason(), document_reason(changes, self.config))
        rows = project(changes.withColumn("reject", reason), self.config, self.policy)
        rows = with_tokens(rows, self.config) if self.config.store_tokens else rows
        control = F.coalesce(F.col("op").isin(*CONTROL_OPS), F.lit(False))
        name = F.when(control, CONTROL).otherwise(F.coalesce("index_name", F.lit(CONTROL)))
        return rows.withColumns({"index_name": name, "nth": F.lit(nth).cast("bigint")})

    # -- log --------------------------------------------------------------------------------

    def append(self, changes: DataFrame, batch: str | None = None, nth: int = 0, files_per_index: int | None = None) -> str:
        """Appends a batch of change rows and returns its name.

        Writing a named batch again replaces it, which makes a repeated micro-batch harmless.
        """
        batch = batch or f"{time.time_ns():020d}-{uuid.uuid4().hex}{UPSERT if nth else ''}"
        rows = self.log_rows(changes, nth)
        if files_per_index:
            # Fewer, larger files; the hash spreads a hot index over several tasks.
            rows = rows.repartition(F.col("index_name"), F.pmod(F.xxhash64("uid"), F.lit(files_per_index)))
        rows.write.mode("overwrite").partitionBy("index_name").parquet(f"{self.log_path}/batch={batch}")
        return batch

    def batches(self) -> list[str]:
        """The complete batches of the log."""
        return [n.removeprefix("batch=") for n in files.complete(self.spark, self.log_path)]

    def log(self, batches: Iterable[str] | None = None) -> DataFrame:
        """The rows of the given batches, or of all that are kept."""
        paths = [f"{self.log_path}/batch={b}" for b in (self.batches() if batches is None else batches)]
        if not paths:
            return self.spark.createDataFrame([], self.log_schema)
        return self.spark.read.schema(self.log_schema).option("basePath", self.log_path).parquet(*paths)

    def cut(self) -> Cut:
        """The point the index has reached; reads nothing but ``seq`` of the batches above the head."""
        head = self.head()
        folded = set(head.batches)
        above = tuple(b for b in self.batches() if b not in folded)
        newest = F.max(F.struct("seq", "nth"))
        last = self._usable(self.log(above), head).agg(newest).first()[0] if above else None
        reached = (head.as_of_seq, head.as_of_nth)
        return Cut(*max(reached, tuple(last) if last else reached), above, head)

    @staticmethod
    def _late(head: Commit) -> Column:
        if head.floor is not None:
            return S.order("seq", "nth", NTH) < F.lit(str(head.floor)).cast(ORDER)
        return (F.col("seq") < head.as_of_seq) | ((F.col("seq") == head.as_of_seq) & (F.col("nth") <= head.as_of_nth))

    def _usable(self, rows: DataFrame, head: Commit) -> DataFrame:
        return rows.where(F.col("reject").isNull() & ~self._late(head))

    def pending(self, cut: Cut | None = None) -> DataFrame:
        """The changes above a version's bases (the newest version's by default) that can be applied."""
        cut = cut or self.cut()
        return self._usable(self.log(cut.batches), cut.head)

    def upsert(self, documents: DataFrame) -> None:
        """Indexes documents (``database, collection, uid, doc``; unique keys) outside the feed.

        Whatever the clock says, they come after everything that the store holds.
        """
        cut = self.cut()
        self.append(document_upserts(documents, cut.as_of), nth=max(cut.nth + 1, time.time_ns()))

    # -- rejects ------------------------------------------------------------------------------

    def _left_out(self, cut: Cut) -> DataFrame:
        """What the batches of a cut hold that is not applied, and why."""
        rows, head = self.log(cut.batches), cut.head
        reason = F.coalesce("reject", F.when(self._late(head), "late"))
        found = rows.select(*CHANGE_COLUMNS, reason.alias("reason")).where(F.col("reason").isNotNull())
        pending = self._usable(rows, head)
        usable = pending.where("nth = 0").drop("nth", "index_name", "reject")
        conflicts = sequence_conflicts(usable)
        if not conflicts.isEmpty():
            named = usable.select(*CHANGE_COLUMNS).join(conflicts, "seq").distinct()
            found = found.unionByName(named.select(*CHANGE_COLUMNS, "reason"))
        if self.policy.update == "merge" and self.late is None:  # else the document may still come
            # Documents indexed outside the feed are inserts like others, in their place of the order.
            events, base = self._ordered(pending.select(*CHANGE_COLUMNS, "nth"), cut, self.base_rows(head))
            lost = updates_without_target(events.drop("nth"), self.policy, self.config.route, base)
            seq = F.col("seq") if isinstance(events.schema["seq"].dataType, T.LongType) else F.expr(f"seq div {NTH}BD")
            found = found.unionByName(lost.withColumn("seq", seq.cast("bigint")))
        return found

    def rejects(self) -> DataFrame:
        """Changes that were not applied, with the reason, of all versions and above.

        Unusable rows, rows that came after their version, merging updates without a document, and
        changes that share a ``seq`` (one of them is applied).
        """
        cut = self.cut()
        found = self._left_out(cut)
        if cut.head.rejects:
            paths = [f"{self.root}/rejects/{name}" for name in cut.head.rejects]
            found = found.unionByName(self.spark.read.schema(REJECT_SCHEMA).parquet(*paths))
        return found

    # -- versions -----------------------------------------------------------------------------

    def _versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in files.names(self.spark, self.commit_path) if n.endswith(".json")]

    def _commit(self, version: int) -> Commit:
        values = json.loads(files.read_text(self.spark, f"{self.commit_path}/{version:020d}.json"))
        return Commit(**values | {"batches": tuple(values["batches"]), "rejects": tuple(values["rejects"])})

    def history(self) -> DataFrame:
        """(version, as_of_seq, reason) of the versions that are kept."""
        commits = [self._commit(v) for v in self._versions()]
        return self.spark.createDataFrame([(c.version, c.as_of_seq, c.reason) for c in commits],
                                          "version bigint, as_of_seq bigint, reason string")

    def head(self, version: int | None = None) -> Commit:
        """The newest commit, or the one asked for."""
        versions = self._versions()
        if not versions or version not in (None, *versions):
            return Commit()
        found = self._commit(versions[-1] if version is None else version)
        if (found.floor is None) != (self.late is None):
            raise ValueError("whether late changes are folded is decided with the first version")
        return found

    def base_rows(self, commit: Commit | None = None, indices: Sequence[str] | None = None) -> DataFrame | None:
        """Index rows of a version, each carrying the ``seq`` the version covers; some indices' only, if named.

        A base that is missing is an error: only an index that was never written is empty.
        """
        commit = commit or self.head()
        rows = self._base_scan(commit, indices)
        if rows is None:
            return None
        rows = rows if commit.floor is None else rows.where(S.ALIVE).drop(*STATE_COLUMNS)
        return rows.withColumn("seq", F.lit(commit.as_of_seq).cast("bigint"))

    def _base_scan(self, commit: Commit, indices: Sequence[str] | None) -> DataFrame | None:
        """The bases of a version as they are written."""
        if not commit.version:
            return None
        data = T.StructType([f for f in self.log_schema.fields
                             if f.name not in ("op", "seq", "nth", "reject", "batch", "index_name")])
        wanted = {i: f for i, f in commit.bases.items() if indices is None or i in indices}
        place = T.StructType([T.StructField(c, T.StringType()) for c in ("base", "index_name")])
        held = [] if commit.floor is None else S.STATE_FIELDS
        whole = T.StructType([*data.fields, *held, *place.fields])
        if not wanted:
            rows = self.spark.createDataFrame([], whole)
        else:
            # All folders in one scan; what a folder holds of indices that were rewritten since is pruned.
            paths = sorted({f"{self.root}/bases/{f}" for f in wanted.values()})
            rows = self.spark.read.schema(whole).option("basePath", f"{self.root}/bases").parquet(*paths)
            rows = rows.where(F.concat_ws("/", "base", "index_name").isin([f"{f.removeprefix('base=')}/{i}" for i, f in wanted.items()]))
        return rows.drop("base")

    def _ordered(self, events: DataFrame, cut: Cut, base: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
        """``seq`` and ``nth`` as one number in ``seq``, where documents came from outside the feed; a feed alone does without."""
        head = cut.head
        if head.as_of_nth or any(b.endswith(UPSERT) for b in cut.batches):
            events = events.withColumn("seq", S.order("seq", "nth", NTH))
            if base is not None:
                base = base.withColumn("seq", F.lit(str(head.as_of_seq * NTH + head.as_of_nth)).cast(ORDER))
        return events, base

    def _fold(self, events: DataFrame, cut: Cut, base: DataFrame | None, delta_path: str | None) -> DataFrame:
        events, base = self._ordered(events.drop("batch", "index_name", "reject"), cut, base)
        return apply_changes(events.drop("nth"), self.policy, self.config.route, base, self.broadcast_rows, delta_path)

    def _drops(self, cut: Cut) -> DataFrame:
        """Drop events of a cut, and those below it that changes may still come below of."""
        head, route = cut.head, self.config.route
        found = drop_events(self.pending(cut).withColumn("seq", S.order("seq", "nth", NTH)), route).drop("index_name")
        if head.drops:
            older = self.spark.read.schema(DROPS).parquet(f"{self.root}/drops/{head.drops}")
            found = found.unionByName(older.where(F.col("seq") >= F.lit(str(head.floor)).cast(ORDER)))
        return found.select("op", *NAMESPACE, "seq")

    def states(self, cut: Cut, index: str | None = None) -> DataFrame:
        """The states of all documents, dead ones too, with the batches of a cut folded in; see ``operators.states``."""
        route, head = self.config.route, cut.head
        events = self.pending(cut).withColumn("seq", S.order("seq", "nth", NTH))
        if index is not None:
            events = events.where(F.col("index_name").isin(index, CONTROL))
        events = events.drop("batch", "index_name", "reject", "nth")
        base = self._base_scan(head, None if index is None else [index])
        # A base that was not rewritten since may hold what the head has forgotten.
        base = None if base is None else S.forgotten(base, head.floor).drop(S.ALIVE)
        touched = events.where(~F.col("op").isin(*CONTROL_OPS)).select(*NAMESPACE, "uid")
        rows = S.combined(base, S.states(events, self.policy, route), self.policy, touched, self.broadcast_rows)
        return S.settled(rows, barriers(self._drops(cut), self.policy, route, self.broadcast_rows), self.policy)

    def rows(self, cut: Cut | None = None, index: str | None = None, delta_path: str | None = None) -> DataFrame:
        """Current index rows: the newest bases with the batches above them folded on top.

        With ``delta_path`` a large folded delta is written there at once and read from there.
        """
        cut = cut or self.cut()
        if self.late is not None:
            rows = self.states(cut, index).where(S.ALIVE).drop(*STATE_COLUMNS).withColumn("seq", F.lit(cut.as_of).cast("bigint"))
            return rows if index is None else rows.where(F.col("index_name") == index)
        events, base = self.pending(cut), self.base_rows(cut.head, None if index is None else [index])
        if index is not None:
            events = events.where(F.col("index_name").isin(index, CONTROL))
        rows = self._fold(events, cut, base, delta_path)
        return rows if index is None else rows.where(F.col("index_name") == index)

    def view(self, index: str | None = None) -> IndexView:
        """The index as documents; naming one index prunes the partitions of all others."""
        return IndexView(index_documents(self.rows(index=index)), self.config)

    def version(self, number: int) -> IndexView:
        """Index documents exactly as committed in a version; version 0 is the empty index."""
        rows = self.base_rows(self.head(number))
        if rows is None and number == 0:
            rows = self.spark.createDataFrame([], T.StructType([f for f in self.log_schema.fields if f.name not in ("op", "nth", "reject", "batch")]))
        if rows is None:
            raise LookupError(f"no version {number}")
        return IndexView(index_documents(rows), self.config)

    def changes(self, old: int, new: int, columns: Sequence[str] | None = None, digests: bool = False) -> DataFrame:
        """Actions that turn one version into a later one.

        If only compactions lie between them, the log names the keys and namespaces that can differ, and
        nothing else is compared; ``columns`` restricts the documents' fields. With ``digests`` bodies are digests.
        """
        pick = lambda df: df.select(*METADATA, *columns) if columns else df
        before, after = (pick(self.version(n).documents) for n in (old, new))
        touched, cleared = self._between(old, new)
        return actions(before, after, self.policy, touched, cleared, cleared if self.late is not None else (), digests)

    def altered(self, old: int, new: int, columns: Sequence[str]) -> tuple[DataFrame, DataFrame] | None:
        """The documents of two versions that the log between them can have altered; None if the log does not tell."""
        touched, cleared = self._between(old, new)
        if touched is None:
            return None
        keys = document_key(self.policy)
        before, after = (self.version(n).documents.select(*METADATA, *columns) for n in (old, new))
        wanted = touched.select(*keys).distinct()
        wanted = F.broadcast(wanted) if fits_broadcast(wanted, self.broadcast_rows) else wanted
        return narrowed(before, keys, wanted, cleared), narrowed(after, keys, wanted, cleared if self.late is not None else ())

    def _between(self, old: int, new: int) -> tuple[DataFrame | None, Sequence[Barrier]]:
        """The document keys and the drops that the log names between two versions; no keys if other commits lie between."""
        first, last = self.head(old), self.head(new)
        between = [self._commit(v) for v in self._versions() if old < v <= new]
        folded = set(last.batches) - set(first.batches)
        told = all(c.reason == "compact" for c in between) and folded <= set(self.batches())
        if not told:
            return None, ()
        log = self.log(sorted(folded)).where("reject is null")
        touched = log.where(F.col("index_name") != CONTROL).select(
            "index_name", F.col("uid").alias("_id"), F.col("collection").alias("_collection"), F.col("database").alias("_database"))
        return touched, barriers(log.drop("index_name"), self.policy, self.config.route, self.broadcast_rows)

    # -- commits ------------------------------------------------------------------------------

    def touched(self, cut: Cut) -> set[str] | None:
        """The indices that the changes of a cut can alter; None for all."""
        if not cut.batches:
            return set()
        pending = self.pending(cut)
        named = pending.where(F.col("index_name") != CONTROL).select("index_name")
        drops = pending.where((F.col("index_name") == CONTROL) & F.col("op").isin(DROP, DROP_DATABASE))
        kinds = {r.op for r in drops.select("op").distinct().collect()}
        if DROP_DATABASE in kinds and self.policy.drop_database != "ignore":
            return None
        dropped = drops.where(F.col("op") == DROP).select(self.config.route(F.col("database"), F.col("collection")).alias("index_name"))
        # One row per index.
        return {r.index_name for r in named.unionByName(dropped).distinct().collect()}

    def commit(self, rows: DataFrame, cut: Cut, reason: str, indices: set[str] | None = None,
               left_out: DataFrame | None = None) -> Commit:
        """Makes ``rows``, which cover the batches of ``cut``, the next version; ``left_out`` are further rejects.

        With ``indices``, ``rows`` replace these alone and other indices keep their base folders. Of two
        writers that start from one version, the second fails and leaves the index as it is.
        """
        head, name = cut.head, f"base={uuid.uuid4().hex}"
        floor, drops, held = None, "", []
        if self.late is not None:
            held = list(STATE_COLUMNS)
            if S.ALIVE in rows.columns:
                floor = max(head.floor or 0, (cut.as_of - self.late) * NTH)
                rows, drops = S.forgotten(rows, floor), self._write_drops(cut, floor)
            else:
                floor = cut.as_of * NTH + cut.nth + 1
                rows = S.inserted(rows, floor - 1)
        known = set(head.bases) | {r.index_name for r in rows.select("index_name").distinct().collect()} if indices is None else indices
        if indices is not None:
            rows = rows.where(F.col("index_name").isin(sorted(indices)))
        bases = {i: f for i, f in head.bases.items() if i not in known}
        if known:
            # Rebalancing gives each index few, evenly sized files and splits a large index over many; within a file keys
            # are in order, and a bloom filter tells which files may hold an id.
            columns = ["uid", *NAMESPACE, "index_name", *payload_columns(rows), *held]
            out = rows.select(columns).hint("rebalance", "index_name").sortWithinPartitions("index_name", "uid")
            path = f"{self.root}/bases/{name}"
            out.write.option("parquet.bloom.filter.enabled#uid", "true").partitionBy("index_name").parquet(path)
            there = {unquote(n.removeprefix("index_name=")) for n in files.names(self.spark, path) if n.startswith("index_name=")}
            bases |= {i: name for i in known if i in there}
            if not there:
                files.remove(self.spark, path)
        rejects = head.rejects
        if cut.batches or left_out is not None:
            found = self._left_out(cut)
            found = found if left_out is None else found.unionByName(left_out)
            found.write.parquet(f"{self.root}/rejects/{name.removeprefix('base=')}")
            rejects = (*rejects, name.removeprefix("base="))
        kept = set(self.batches())
        batches = tuple(b for b in head.batches if b in kept) + cut.batches
        record = Commit(head.version + 1, cut.as_of, cut.nth, bases, batches, rejects, reason, floor, drops)
        if not files.publish(self.spark, f"{self.commit_path}/{record.version:020d}.json", json.dumps(asdict(record))):
            raise RuntimeError("the index was committed by someone else meanwhile")
        return record

    def _write_drops(self, cut: Cut, floor: int) -> str:
        """The last drop of each kind and namespace from ``floor`` on, written for later versions."""
        name = uuid.uuid4().hex
        kept = self._drops(cut).where(F.col("seq") >= F.lit(str(floor)).cast(ORDER))
        kept.groupBy("op", *NAMESPACE).agg(F.max("seq").alias("seq")).write.parquet(f"{self.root}/drops/{name}")
        return name

    def compact(self) -> Commit:
        """Folds the log into new bases of the indices it touches, so later reads fold only what comes after."""
        cut = self.cut()
        if self.late is not None:
            return self.commit(self.states(cut), cut, "compact", self.touched(cut))
        draft = f"{self.root}/drafts/{uuid.uuid4().hex}"
        try:
            return self.commit(self.rows(cut, delta_path=draft), cut, "compact", self.touched(cut))
        finally:
            files.remove(self.spark, draft)

    def vacuum(self, keep: int = 2) -> None:
        """Removes what only versions older than the ``keep`` newest need: their files, bases and folded batches.

        Readers of an older version must have ended.
        """
        versions = self._versions()
        commits = [self._commit(v) for v in versions]
        old, kept = commits[:-keep], commits[-keep:]
        if not old:
            return
        # Only what an old version names is removed: other folders may belong to a commit under way.
        used = {f for c in kept for f in c.bases.values()}
        for name in {f for c in old for f in c.bases.values()} - used:
            files.remove(self.spark, f"{self.root}/bases/{name}")
        for name in {c.drops for c in old} - {c.drops for c in kept}:
            files.remove(self.spark, f"{self.root}/drops/{name}")
        for batch in kept[0].batches:
            files.remove(self.spark, f"{self.log_path}/batch={batch}")
        for commit in old:
            files.remove(self.spark, f"{self.commit_path}/{commit.version:020d}.json")

    def drop_all(self) -> Commit:
        """Removes every index."""
        cut = self.cut()
        nothing = (self.base_rows(cut.head) if cut.head.version else self.rows(cut)).where(F.lit(False))
        return self.commit(nothing, cut, "drop_all", set(cut.head.bases))

    def drop_index(self, index: str) -> Commit:
        """Removes one index; the others keep their folders unless the log above touches them."""
        cut = self.cut()
        touched = self.touched(cut)
        rows = self.rows(cut).where(F.col("index_name") != index)
        return self.commit(rows, cut, "drop_index", None if touched is None else touched | {index})

    def clear(self, database: str, collection: str) -> Commit:
        """Removes one collection at once, without a drop event."""
        cut = self.cut()
        touched = self.touched(cut)
        name = self.spark.range(1).select(self.config.route(F.lit(database), F.lit(collection)).alias("i")).first().i
        rows = self.rows(cut).where(~((F.col("database") == database) & (F.col("collection") == collection)))
        return self.commit(rows, cut, "clear", None if touched is None else touched | {name})


def save_table(rows: DataFrame, table: str, buckets: int | None = None, path: str | None = None) -> None:
    """Index rows as a catalog table; bucketing by key lets later joins on it skip the shuffle."""
    writer = rows.write.mode("overwrite").partitionBy("index_name")
    if buckets:
        writer = writer.bucketBy(buckets, "_id").sortBy("_id")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
