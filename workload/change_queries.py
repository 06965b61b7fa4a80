"""Change apply, rebuild, store and streaming queries over the event feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex import (
    EMBEDDED,
    FULL_REPLACE,
    PARTIAL_UPDATE,
    ApplyPolicy,
    FieldRule,
    IndexConfig,
    IndexService,
    IndexStore,
    allow_collections,
    apply_changes,
    clear_collections,
    fold_keys,
    index_documents,
    project,
)
from foldex.functions import mappers as m
from foldex.operators import rejects as R
from foldex.operators.sink import export_changes, sent_actions
from foldex.plans.rebuild import backfill_rows, reindex, reindex_rows, snapshot_rows
from foldex.session import scratch
from foldex.sources.changes import parse_events, stream_table
from foldex.sources.feed import feed_stream
from workload import derive
from workload.mapping_queries import TEXT_CONFIG

ALLOWED = ["c0", "c1", "c2"]
EVENT_RULES = (
    FieldRule("event_type", "event_type", m.to_string, stored=True, keyword=True),
    FieldRule("value", "value", m.to_double, stored=True),
    FieldRule("ts", "day", m.to_date, stored=True, keyword=True),
    FieldRule("props", "props", m.to_string, stored=True, keyword=True),
)
EVENT_CONFIG = IndexConfig(rules={c: EVENT_RULES for c in ALLOWED})
REPLACE = ApplyPolicy()
MERGE = ApplyPolicy(update="merge")
IGNORE = ApplyPolicy(update="ignore")
OUTPUT = ("index_name", "_id", "_collection", "_database", "event_type", "value", "day", "props")


def feed(spark: SparkSession, sf_dir: str, *ops: str) -> DataFrame:
    """The allowed part of the feed, or only some kinds of change of it."""
    rows = allow_collections(derive.changes(spark, sf_dir), ALLOWED)
    return rows.where(F.col("op").isin(*ops)) if ops else rows


def applied(events: DataFrame, policy: ApplyPolicy, config: IndexConfig = EVENT_CONFIG) -> DataFrame:
    """Index documents after a feed: project first, so that only index fields are shuffled."""
    rows = project(events, config, policy).drop("index_name")
    return index_documents(apply_changes(rows, policy, config.route))


# -- feed ------------------------------------------------------------------------------------------


def change_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON change events to change rows, documents parsed by their declared schema."""
    schema = T.StructType().add("event_type", T.StringType()).add("value", T.DoubleType()).add("props", T.StringType())
    collections = ["c0", "c1", "c2", "c3"]
    rules = [r for r in EVENT_RULES if r.field != "ts"]
    config = IndexConfig(rules={c: rules for c in collections}, schemas={c: schema for c in collections})
    rows = parse_events(derive.raw_events(derive.table(spark, sf_dir, "events")))
    return project(rows, config).drop("index_name")


def allowlist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).select("seq", "op", "database", "collection", "uid")


# -- change apply ----------------------------------------------------------------------------------


def cdc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir, "insert"), REPLACE).select(*OUTPUT)


def cdc_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir, "insert", "delete"), REPLACE).select(*OUTPUT)


def cdc_update_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir, "insert", "update", "delete"), REPLACE).select(*OUTPUT)


def cdc_update_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir, "insert", "update", "delete"), MERGE).select(*OUTPUT)


def cdc_update_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir, "insert", "update", "delete"), IGNORE).select(*OUTPUT)


def cdc_drop_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir, "insert", "update", "delete", "drop"), REPLACE).select(*OUTPUT)


def cdc_drop_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir, "insert", "update", "delete", "drop_database"), REPLACE).select(*OUTPUT)


def cdc_full_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir), REPLACE).select(*OUTPUT)


def cdc_merge_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merging updates keep extender values of older images that a newer one lacks."""
    def extend(ctx) -> dict[str, Column]:
        kind, value = ctx.source["event_type"], F.array(ctx.source["props"])
        return {"click": F.when(kind == "click", value), "purchase": F.when(kind == "purchase", value)}

    df = applied(feed(spark, sf_dir), MERGE, IndexConfig(rules=EVENT_CONFIG.rules, extender=extend))
    return df.select("_id", "_collection", "_database", "value", F.col("ext")["click"][0].alias("click"),
                     F.col("ext")["purchase"][0].alias("purchase"))


def shared_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with keys that several namespaces share."""
    number = F.col("uid").cast("bigint")
    return feed(spark, sf_dir).withColumn("uid", derive.uid(F.floor(number / 64) * 8 + number % 8))


def cdc_index_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All namespaces write one index and a document is identified by its id alone."""
    config = IndexConfig(rules=EVENT_CONFIG.rules, route=lambda database, collection: F.lit("shared"))
    return applied(shared_feed(spark, sf_dir), ApplyPolicy(key="index"), config).select(*OUTPUT)


def cdc_index_key_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates merge into documents that namespaces take over from each other."""
    config = IndexConfig(rules=EVENT_CONFIG.rules, route=lambda database, collection: F.lit("shared"))
    return applied(shared_feed(spark, sf_dir), ApplyPolicy(update="merge", key="index"), config).select(*OUTPUT)


def policy_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir), EMBEDDED).select(*OUTPUT)


def policy_partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir), PARTIAL_UPDATE).select(*OUTPUT)


def policy_full_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applied(feed(spark, sf_dir), FULL_REPLACE).select(*OUTPUT)


def collection_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live documents per collection after the whole feed; reads keys only, no documents."""
    keys = fold_keys(feed(spark, sf_dir), REPLACE, EVENT_CONFIG.route)
    return keys.groupBy("database", "collection").agg(F.count(F.lit(1)).alias("n"))


# -- JSON documents --------------------------------------------------------------------------------


def change_extended_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose ids, numbers and dates are written in extended JSON."""
    events = derive.table(spark, sf_dir, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    document = F.struct(
        F.struct(derive.uid(F.col("user_id")).alias("$oid")).alias("user"),
        F.struct(F.col("event_id").cast("string").alias("$numberLong")).alias("number"),
        F.struct(F.col("value").cast("string").alias("$numberDouble")).alias("value"),
        F.struct(F.struct(millis.alias("$numberLong")).alias("$date")).alias("ts"),
        F.array(F.struct(F.struct(F.lit("7").alias("$numberInt")).alias("n"))).alias("list"),
        F.lit('{"$oid": "kept"}').alias("props"))
    schema = (T.StructType().add("user", T.StringType()).add("number", T.LongType()).add("value", T.DoubleType())
              .add("ts", T.TimestampType()).add("list", T.ArrayType(T.StructType().add("n", T.IntegerType())))
              .add("props", T.StringType()))
    rules = [FieldRule("user", "user", m.to_string), FieldRule("number", "number", m.to_long),
             FieldRule("value", "value", m.to_double), FieldRule("ts", "at", m.to_date, date_format="yyyy-MM-dd HH:mm:ss"),
             FieldRule("list.n", "numbers", m.to_integer_list), FieldRule("props", "props", m.to_string)]
    config = IndexConfig(rules={"c": rules}, schemas={"c": schema})
    event = F.struct(F.col("event_id").alias("seq"), F.lit("insert").alias("operationType"),
                     F.struct(F.lit("db").alias("db"), F.lit("c").alias("coll")).alias("ns"),
                     F.struct(derive.uid(F.col("event_id")).alias("_id")).alias("documentKey"), document.alias("fullDocument"))
    rows = project(parse_events(events.select(F.to_json(event).alias("value"))), config)
    return rows.select("seq", "uid", "user", "number", "value", "at", F.col("numbers")[0].alias("n"), "props")


def reject_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unreadable change leaves the document as it was."""
    schema = derive.event_doc_type(spark, sf_dir)
    config = IndexConfig(rules=EVENT_CONFIG.rules, schemas={c: schema for c in ALLOWED})
    store = IndexStore(spark, scratch(spark, "store"), config, T.StringType(), REPLACE)
    text = F.to_json("doc")
    broken = F.when(F.col("doc.event_type") == "click", F.substring(text, 1, F.length(text) - 1)).otherwise(text)
    store.append(feed(spark, sf_dir).withColumn("doc", broken))
    return output(store)


# -- rejects ---------------------------------------------------------------------------------------


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unusable rows of a feed with an undocumented op and keys missing, and lost updates."""
    rows = derive.changes(spark, sf_dir)
    kind = F.col("doc.event_type")
    broken = rows.withColumns({
        "op": F.when((F.col("op") == "update") & (kind == "purchase"), "rename").otherwise(F.col("op")),
        "uid": F.when(kind != "view", F.col("uid")),
    })
    lost = R.updates_without_target(rows, MERGE)
    return R.rejected(broken).unionByName(lost).select("seq", "op", "reason")


def strict_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose value is text where the rule wants a number."""
    schema = T.StructType().add("value", T.DoubleType())
    rules = [FieldRule("value", "value", m.to_double)]
    config = IndexConfig(rules={c: rules for c in ALLOWED}, schemas={c: schema for c in ALLOWED})
    text = F.to_json(F.struct(F.col("doc.value").cast("string").alias("value")))
    number = F.to_json(F.struct(F.col("doc.value").alias("value")))
    rows = feed(spark, sf_dir, "insert", "update")
    rows = rows.withColumn("doc", F.when(F.col("doc.event_type") == "click", text).otherwise(number))
    return R.type_mismatches(rows, config).select("seq", "reason")


# -- clear, rebuild, backfill ----------------------------------------------------------------------


def stale_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index that lags behind: an older image of every document, and as many deleted ones."""
    docs = derive.text_documents(spark, sf_dir)
    older = docs.withColumn("doc", F.col("doc").withField("source", F.lit("old")))
    gone = older.withColumn("uid", derive.uid(F.col("uid").cast("bigint") + 10_000_000_000))
    return snapshot_rows(older.unionByName(gone), TEXT_CONFIG, REPLACE, -1)


def text_output(rows: DataFrame) -> DataFrame:
    return index_documents(rows).withColumn("text_md5", F.md5("text")).drop("text")


def clear_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_output(clear_collections(stale_index(spark, sf_dir), [("corpus", "en"), ("corpus", "de")]))


def reindex_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derive.text_documents(spark, sf_dir)
    return text_output(reindex_rows(stale_index(spark, sf_dir), docs, ["en", "de"], TEXT_CONFIG, REPLACE, 0, "corpus"))


def initial_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derive.text_documents(spark, sf_dir)
    return text_output(backfill_rows(stale_index(spark, sf_dir), docs, TEXT_CONFIG, REPLACE, 0))


def reindex_two_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuilding the collections of one database leaves another database's collections of these names alone."""
    stale = stale_index(spark, sf_dir)
    both = stale.unionByName(stale.withColumn("database", F.lit("other")))
    docs = derive.text_documents(spark, sf_dir)
    docs = docs.unionByName(docs.withColumn("database", F.lit("third")))
    return text_output(reindex_rows(both, docs, ["en", "de"], TEXT_CONFIG, REPLACE, 0, "corpus"))


def backfill_index_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections share the ids of one index: the document that is written last stays."""
    number = F.col("uid").cast("bigint")
    config = IndexConfig(rules={c: TEXT_CONFIG.rules["en"] for c in ("c0", "c1", "old")},
                         route=lambda database, collection: F.lit("shared"))
    docs = derive.text_documents(spark, sf_dir)
    halves = docs.withColumns({"collection": F.concat(F.lit("c"), number % 2), "uid": derive.uid(F.floor(number / 2))})
    old = snapshot_rows(docs.withColumn("collection", F.lit("old")), config, REPLACE, -1)
    return text_output(backfill_rows(old, halves, config, ApplyPolicy(key="index"), 0))


# -- store and streams -----------------------------------------------------------------------------


def new_store(spark: SparkSession, sf_dir: str, policy: ApplyPolicy = REPLACE) -> IndexStore:
    return IndexStore(spark, scratch(spark, "store"), EVENT_CONFIG, derive.event_doc_type(spark, sf_dir), policy)


def output(store: IndexStore) -> DataFrame:
    return store.view().documents.select(*OUTPUT)


def stream_cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream: normalise, filter, project, append; then read the index."""
    schema = derive.table(spark, sf_dir, "events").schema
    store = new_store(spark, sf_dir)
    source = f"{sf_dir}/events*.parquet"  # a pattern fits one file as well as a folder of files
    service = IndexService(store, lambda: derive.changes_of(stream_table(spark, source, schema)), ALLOWED)
    service.drain()
    return output(store)


class StagedFeed:
    """The feed as files that arrive in two parts, earlier and later events."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.path = spark, scratch(spark, "feed")
        self.rows = derive.changes(spark, sf_dir)
        self.half = self.rows.agg(F.max("seq")).first()[0] // 2

    def arrive(self, part: int) -> None:
        first = F.col("seq") <= self.half
        rows = self.rows.where(first if part == 1 else ~first)
        rows.repartitionByRange(4, "seq").write.mode("append").parquet(self.path)

    def stream(self) -> DataFrame:
        return stream_table(self.spark, self.path, self.rows.schema, max_files_per_trigger=1)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped half way and started anew from its checkpoint."""
    store, staged = new_store(spark, sf_dir), StagedFeed(spark, sf_dir)
    for part in (1, 2):
        staged.arrive(part)
        IndexService(store, staged.stream, ALLOWED).drain()
    return output(store)


def stream_feed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a schema from rolling files: stopped in the middle of a file, then started anew from its checkpoint."""
    path, positions = scratch(spark, "events"), scratch(spark, "positions")
    fields = tuple(derive.EVENT_FIELDS)
    events = derive.table(spark, sf_dir, "events").repartitionByRange(3, "event_id").sortWithinPartitions("event_id")
    derive.raw_events(events, fields).write.text(path)
    store = IndexStore(spark, scratch(spark, "store"), EVENT_CONFIG, T.StringType(), REPLACE)
    IndexService(store, lambda: feed_stream(spark, path, 100_000, positions), ALLOWED).drain()
    IndexService(store, lambda: feed_stream(spark, path), ALLOWED).drain()
    return output(store)


def stream_pause_reindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collection is rebuilt from a snapshot while the feed is paused, then the feed goes on."""
    store, staged = new_store(spark, sf_dir), StagedFeed(spark, sf_dir)
    service = IndexService(store, staged.stream, ALLOWED)
    staged.arrive(1)
    service.drain()
    keys = ("database", "collection", "uid")
    images = staged.rows.where((F.col("seq") <= staged.half) & F.col("op").isin("insert", "update", "delete"))
    snapshot = images.groupBy(*keys).agg(F.struct(
        F.lit("snapshot").alias("event_type"), F.max("doc.value").alias("value"), F.max("doc.ts").alias("ts"),
        F.max("doc.props").alias("props")).alias("doc"))
    service.execute(reindex(snapshot, ["c0"], ["db0", "db1"]))
    staged.arrive(2)
    service.drain()
    return output(store)


def custom_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user action that prunes the index while the feed is paused."""
    store, staged = new_store(spark, sf_dir), StagedFeed(spark, sf_dir)
    service = IndexService(store, staged.stream, ALLOWED)
    staged.arrive(1)
    staged.arrive(2)
    service.drain()

    def prune(target: IndexStore) -> None:
        cut = target.cut()
        target.commit(target.rows(cut).where(F.col("value") >= 10), cut, "prune")

    service.execute(prune)
    return output(store)


def store_overlapping_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that lands while the log is being compacted is folded on top of the compacted version."""
    store, staged = new_store(spark, sf_dir), StagedFeed(spark, sf_dir)
    events = allow_collections(staged.rows, ALLOWED)
    store.append(events.where(F.col("seq") <= staged.half))
    cut = store.cut()
    store.append(events.where(F.col("seq") > staged.half))
    store.commit(store.rows(cut), cut, "compact", store.touched(cut))
    return output(store)


def store_upsert_then_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents indexed outside the feed do not use up its next number."""
    store, staged = new_store(spark, sf_dir), StagedFeed(spark, sf_dir)
    events = allow_collections(staged.rows, ALLOWED)
    store.append(events.where(F.col("seq") <= staged.half))
    document = F.struct(F.lit("supplier").alias("event_type"), F.col("s_acctbal").alias("value"),
                        F.lit("2024-02-03").cast("timestamp").cast("timestamp_ntz").alias("ts"), F.col("s_name").alias("props"))
    suppliers = derive.table(spark, sf_dir, "supplier").select(
        F.lit("db2").alias("database"), F.lit("c1").alias("collection"), derive.uid(F.col("s_suppkey")).alias("uid"), document.alias("doc"))
    store.upsert(suppliers)
    store.compact()
    store.append(events.where(F.col("seq") > staged.half))
    return output(store)


def store_late_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that come after the version they belong to stay on record over later versions."""
    store, staged = new_store(spark, sf_dir), StagedFeed(spark, sf_dir)
    events = allow_collections(staged.rows, ALLOWED)
    store.append(events.where(F.col("seq") > staged.half))
    store.compact()
    store.append(events.where(F.col("seq") <= staged.half))
    store.compact()
    store.compact()
    return store.rejects().select("seq", "op", "reason")


def late_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in three parts out of order, compacted in between: every change has the effect it has in its turn."""
    staged = StagedFeed(spark, sf_dir)
    doc_type = derive.event_doc_type(spark, sf_dir)
    store = IndexStore(spark, scratch(spark, "store"), EVENT_CONFIG, doc_type, REPLACE, late=2 * staged.half + 1)
    events = allow_collections(staged.rows, ALLOWED)
    part = F.when(F.col("seq") > staged.half, F.lit(0)).otherwise(1 + F.col("seq") % 2)
    for number in range(3):
        store.append(events.where(part == number))
        if number < 2:
            store.compact()
    return output(store)


def action_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net changes between two committed versions of the index."""
    store, staged = new_store(spark, sf_dir), StagedFeed(spark, sf_dir)
    early, late = F.col("seq") <= staged.half, F.col("seq") > staged.half
    events = allow_collections(staged.rows, ALLOWED)
    store.append(events.where(early))
    first = store.compact()
    store.append(events.where(late))
    second = store.compact()
    return store.changes(first.version, second.version, ["event_type", "value", "day"]).select("index_name", "uid", "action", "body")


def action_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net changes sent batch by batch, one of them again after a failure that came too late: what a reader of the last batch gets."""
    store, staged = new_store(spark, sf_dir), StagedFeed(spark, sf_dir)
    target, fields = scratch(spark, "actions"), ["event_type", "value", "day"]
    events = allow_collections(staged.rows, ALLOWED)
    store.append(events.where(F.col("seq") <= staged.half))
    first = store.compact().version
    export_changes(store, target, fields)
    store.append(events.where(F.col("seq") > staged.half))
    second = store.compact().version
    export_changes(store, target, fields)
    sent = sent_actions(spark, target, after=first)
    sent.drop("number").write.format("action_batches").option("path", target).option("number", second).mode("append").save()
    return sent_actions(spark, target, after=first).select("index_name", "uid", "action", "body")


QUERIES = {
    "change_normalise": change_normalise,
    "allowlist_filter": allowlist_filter,
    "cdc_upsert": cdc_upsert,
    "cdc_delete": cdc_delete,
    "cdc_update_replace": cdc_update_replace,
    "cdc_update_merge": cdc_update_merge,
    "cdc_update_ignore": cdc_update_ignore,
    "cdc_drop_collection": cdc_drop_collection,
    "cdc_drop_database": cdc_drop_database,
    "cdc_full_replay": cdc_full_replay,
    "cdc_merge_ext": cdc_merge_ext,
    "cdc_index_key": cdc_index_key,
    "cdc_index_key_merge": cdc_index_key_merge,
    "change_extended_json": change_extended_json,
    "reject_unreadable": reject_unreadable,
    "policy_embedded": policy_embedded,
    "policy_partial_update": policy_partial_update,
    "policy_full_replace": policy_full_replace,
    "collection_size": collection_size,
    "rejects": rejects,
    "strict_types": strict_types,
    "clear_collection": clear_collection,
    "reindex_collections": reindex_collections,
    "initial_backfill": initial_backfill,
    "reindex_two_databases": reindex_two_databases,
    "backfill_index_key": backfill_index_key,
    "store_overlapping_append": store_overlapping_append,
    "store_upsert_then_feed": store_upsert_then_feed,
    "store_late_rejects": store_late_rejects,
    "late_fold": late_fold,
    "stream_cdc_apply": stream_cdc_apply,
    "stream_restart": stream_restart,
    "stream_pause_reindex": stream_pause_reindex,
    "custom_action": custom_action,
    "action_export": action_export,
    "action_sink": action_sink,
    "stream_feed_source": stream_feed_source,
}
