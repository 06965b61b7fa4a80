"""Store versions, streaming apply, pause and rebuild, late events, export."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from replay import random_events, replay, route
from test_fold import route_column

from foldex import ApplyPolicy, FieldRule, IndexConfig, IndexService, IndexStore
from foldex.functions import mappers as m
from foldex.operators.export import actions, push, write_actions
from foldex.plans import files
from foldex.plans.rebuild import backfill, reindex
from foldex.plans.store import save_table
from foldex.sources.changes import stream_events, stream_table

COLLECTIONS = ("c0", "c1", "c2")
SCHEMA = ("seq bigint, op string, database string, collection string, uid string,"
          " doc struct<value:bigint,ext:map<string,array<string>>>")
CONFIG = IndexConfig(
    rules={c: [FieldRule("value", "value", m.to_long)] for c in COLLECTIONS},
    route=route_column,
    extender=lambda ctx: {k: ctx.source["ext"][k] for k in ("x", "y")},
)


def frame(spark, events):
    return spark.createDataFrame([(*e[:5], None if e[6] is None else (e[5], e[6])) for e in events], SCHEMA)


def new_store(spark, folder, policy=None, **kw):
    return IndexStore(spark, folder("store"), CONFIG, frame(spark, []).schema["doc"].dataType, policy, **kw)


def docs(view):
    return {(r._database, r._collection, r._id): (r.value, dict(r.ext or {})) for r in view.documents.collect()}


def wanted(events, policy):
    return {d[:3]: (d[3], d[4]) for d in replay(events, policy).values()}


@pytest.mark.parametrize("update", ["replace", "merge"])
def test_compaction_does_not_change_the_index(spark, folder, update):
    policy = ApplyPolicy(update=update)
    events = random_events(21)
    store = new_store(spark, folder, policy)
    for part in range(3):
        store.append(frame(spark, events[part * 130: (part + 1) * 130 if part < 2 else None]))
        if part < 2:
            assert store.compact().version == part + 1
    assert docs(store.view()) == wanted(events, policy)
    store.compact()
    assert docs(store.view()) == wanted(events, policy)
    assert docs(store.version(1)) == wanted(events[:130], policy)
    assert [r.version for r in store.history().orderBy("version").collect()] == [1, 2, 3]


def test_large_delta_is_joined_not_broadcast(spark, folder):
    policy = ApplyPolicy(update="merge")
    events = random_events(22)
    store = new_store(spark, folder, policy, broadcast_rows=1)
    store.append(frame(spark, events[:200]))
    store.compact()
    store.append(frame(spark, events[200:]))
    assert docs(store.view()) == wanted(events, policy)


def test_one_index_reads_its_partitions_only(spark, folder):
    events = random_events(23)
    store = new_store(spark, folder)
    store.append(frame(spark, events[:200]))
    store.compact()
    store.append(frame(spark, events[200:]))
    name = route("db0", "c0")
    view = store.view(name)
    assert docs(view) == {k: v for k, v in wanted(events, store.policy).items() if route(*k[:2]) == name}
    plan = view.documents._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(index_name" in plan


def test_clear_and_drop_all(spark, folder):
    events = [e for e in random_events(24) if not e[1].startswith("drop")]
    store = new_store(spark, folder)
    store.append(frame(spark, events))
    before = wanted(events, store.policy)
    store.clear("db0", "c0")
    assert docs(store.view()) == {k: v for k, v in before.items() if k[:2] != ("db0", "c0")}
    store.drop_all()
    assert docs(store.view()) == {}
    later = [(10**6, "insert", "db0", "c0", "u1", 5, {})]
    store.append(frame(spark, later))
    assert docs(store.view()) == {("db0", "c0", "u1"): (5, {})}


def test_overtaken_commit_fails(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, [(1, "insert", "db0", "c0", "a", 1, {})]))
    cut = store.cut()
    store.compact()
    with pytest.raises(RuntimeError):
        store.commit(store.rows(cut), cut, "stale")
    assert set(docs(store.view())) == {("db0", "c0", "a")}


def test_late_and_unusable_rows_are_reported(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, [(10, "insert", "db0", "c0", "u1", 1, {}), (11, "insert", "db0", "c0", None, 1, {})]))
    store.compact()
    store.append(frame(spark, [(5, "insert", "db0", "c0", "u2", 1, {}), (12, "insert", "db0", "c0", "u3", 1, {})]))
    assert set(docs(store.view())) == {("db0", "c0", "u1"), ("db0", "c0", "u3")}
    assert {(r.seq, r.reason) for r in store.rejects().collect()} == {(5, "late"), (11, "missing_key")}


def snapshot(spark, values):
    data = [("db0", c, u, (v, {})) for c, u, v in values]
    return spark.createDataFrame(
        data, "database string, collection string, uid string, doc struct<value:bigint,ext:map<string,array<string>>>")


def test_reindex_and_backfill(spark, folder):
    events = [(1, "insert", "db0", "c0", "a", 1, {}), (2, "insert", "db0", "c1", "b", 2, {})]
    source = snapshot(spark, [("c0", "n", 9), ("c1", "b", 8)])
    store = new_store(spark, folder)
    store.append(frame(spark, events))
    backfill(source)(store)
    assert {k[2]: v[0] for k, v in docs(store.view()).items()} == {"a": 1, "b": 8, "n": 9}
    reindex(source, ["c0"], "db0")(store)
    assert {k[2]: v[0] for k, v in docs(store.view()).items()} == {"b": 8, "n": 9}
    store.append(frame(spark, [(3, "update", "db0", "c0", "n", 10, {})]))
    assert docs(store.view())[("db0", "c0", "n")][0] == 10


def test_single_documents_and_merge_rejects(spark, folder):
    store = new_store(spark, folder, ApplyPolicy(update="merge", key="index"))
    store.append(frame(spark, [(1, "insert", "db0", "c0", "a", 1, {}), (2, "update", "db0", "c0", "lost", 1, {})]))
    store.upsert(snapshot(spark, [("c0", "a", 5), ("c1", "n", 9)]))
    store.compact()
    store.append(frame(spark, [(20, "update", "db1", "c0", "n", 3, {}), (21, "update", "db0", "c1", "n", 4, {}),
                               (22, "update", "db1", "c0", "a", 6, {}), (23, "update", "db0", "c1", "none", 6, {})]))
    assert {k[2]: (k[0], v[0]) for k, v in docs(store.view()).items()} == {"a": ("db1", 6), "n": ("db0", 4)}
    missed = {("lost", "update_without_target"), ("n", "update_without_target"), ("none", "update_without_target")}
    for _ in range(2):
        assert {(r.uid, r.reason) for r in store.rejects().collect()} == missed
        store.compact()


# -- nothing is lost ---------------------------------------------------------------------------------


def test_append_that_overlaps_a_compaction(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, [(1, "insert", "db0", "c0", "a", 1, {})]))
    cut = store.cut()
    store.append(frame(spark, [(1, "insert", "db0", "c0", "late", 1, {}), (2, "insert", "db0", "c0", "b", 2, {})]))
    store.commit(store.rows(cut), cut, "compact", store.touched(cut))
    for _ in range(3):
        assert {k[2] for k in docs(store.view())} == {"a", "b"}
        assert [(r.uid, r.reason) for r in store.rejects().collect()] == [("late", "late")]
        store.compact()


def test_upsert_leaves_the_feed_its_next_number(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, [(100, "drop", "db0", "c0", None, None, None), (99, "insert", "db0", "c0", "old", 0, {})]))
    store.upsert(snapshot(spark, [("c0", "x", 1), ("c0", "y", 1)]))
    store.upsert(snapshot(spark, [("c0", "x", 2)]))
    assert {k[2]: v[0] for k, v in docs(store.view()).items()} == {"x": 2, "y": 1}
    store.compact()
    store.append(frame(spark, [(101, "insert", "db0", "c0", "z", 3, {}), (102, "update", "db0", "c0", "y", 4, {})]))
    store.upsert(snapshot(spark, [("c0", "z", 5)]))
    for _ in range(2):
        assert {k[2]: v[0] for k, v in docs(store.view()).items()} == {"x": 2, "y": 4, "z": 5}
        assert store.rejects().count() == 0
        store.compact()


def test_two_writers_cannot_publish_one_version(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, [(1, "insert", "db0", "c0", "a", 1, {})]))
    one, two = store.cut(), store.cut()
    rows = store.rows(two)
    assert store.commit(store.rows(one), one, "first").version == 1
    with pytest.raises(RuntimeError):
        store.commit(rows, two, "second")
    assert [r.reason for r in store.history().collect()] == ["first"]


def test_missing_base_is_an_error(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, [(1, "insert", "db0", "c0", "a", 1, {})]))
    name = next(iter(store.compact().bases.values()))
    files.remove(spark, f"{store.root}/bases/{name}")
    with pytest.raises(AnalysisException):
        store.view().documents.count()


def test_rejects_of_unreadable_and_conflicting_changes(spark, folder):
    schema = spark.createDataFrame([], "doc struct<value:bigint>").schema["doc"].dataType
    config = IndexConfig(rules={"c0": [FieldRule("value", "value", m.to_long)]}, schemas={"c0": schema}, strict_types=True)
    store = IndexStore(spark, folder("store"), config, spark.createDataFrame([], "doc string").schema["doc"].dataType)
    rows = [(1, "insert", "db0", "c0", "a", '{"value": 1}'), (2, "update", "db0", "c0", "a", "{broken"),
            (3, "update", "db0", "c0", "a", '{"value": "text"}'), (4, "update", "db0", "c0", "a", "[1]"),
            (5, "insert", "db0", "c0", "b", '{"value": {"$numberLong": "7"}}'), (6, "delete", "db0", "c0", "none", None),
            (7, "insert", "db0", "c0", "c", '{"value": 8}'), (7, "insert", "db0", "c0", "c", '{"value": 8}'),
            (8, "insert", "db0", "c0", "d", '{"value": 8}'), (8, "insert", "db0", "c0", "e", '{"value": 8}')]
    store.append(spark.createDataFrame(rows, "seq bigint, op string, database string, collection string, uid string, doc string"))
    want = {(2, "unreadable_document"), (3, "type_mismatch"), (4, "unreadable_document"), (8, "duplicate_seq")}
    for _ in range(3):
        assert {r._id: r.value for r in store.view().documents.collect()} == {"a": 1, "b": 7, "c": 8, "d": 8, "e": 8}
        assert {(r.seq, r.reason) for r in store.rejects().collect()} == want
        store.compact()


def test_drops_count_whatever_document_they_carry(spark, folder):
    schema = spark.createDataFrame([], "doc struct<value:bigint>").schema["doc"].dataType
    rules = [FieldRule("value", "value", m.to_long)]
    config = IndexConfig(rules={"c0": rules, "c1": rules}, schemas={"c0": schema}, strict_types=True)
    store = IndexStore(spark, folder("store"), config, spark.createDataFrame([], "doc string").schema["doc"].dataType)
    rows = [(1, "insert", "db0", "c0", "a", '{"value": 1}'), (2, "insert", "db0", "c1", "b", '{"value": 1}'),
            (3, "insert", "db1", "c1", "c", '{"value": 1}'), (4, "drop", "db0", "c0", None, "{broken"),
            (5, "drop", "db0", "c1", None, '{"value": "text"}'), (6, "insert", "db0", "c0", "d", '{"value": 2}'),
            (7, "drop_database", "db1", None, None, "[1]"), (8, "insert", "db1", "c1", "e", "{broken")]
    store.append(spark.createDataFrame(rows, "seq bigint, op string, database string, collection string, uid string, doc string"))
    for _ in range(2):
        assert {r._id: r.value for r in store.view().documents.collect()} == {"d": 2}
        assert {(r.seq, r.reason) for r in store.rejects().collect()} == {(8, "unreadable_document")}
        store.compact()


# -- layout ------------------------------------------------------------------------------------------


def test_versions_share_the_bases_of_untouched_indices(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, [(i, "insert", "db0", c, f"u{i}", i, {}) for i, c in enumerate(["c0", "c1", "c2"])]))
    first = store.compact()
    store.append(frame(spark, [(10, "update", "db0", "c1", "u1", 9, {})]))
    second = store.compact()
    changed = {i for i in first.bases if first.bases[i] != second.bases[i]}
    assert changed == {route("db0", "c1")} and set(first.bases) == set(second.bases)
    reindex(snapshot(spark, [("c0", "n", 1)]), ["c0"], "db0")(store)
    third = store.head()
    assert {i for i in third.bases if second.bases[i] != third.bases[i]} == {route("db0", "c0")}
    store.drop_index(route("db0", "c2"))
    assert set(store.head().bases) == {route("db0", "c0"), route("db0", "c1")}
    assert {k[2]: v[0] for k, v in docs(store.view()).items()} == {"n": 1, "u1": 9}
    before = docs(store.view())
    store.vacuum(keep=1)
    assert docs(store.view()) == before
    assert store.batches() == [] and len(files.names(spark, f"{store.root}/bases")) == len(set(store.head().bases.values()))
    store.append(frame(spark, [(20, "delete", "db0", "c1", "u1", None, None)]))
    assert {k[2] for k in docs(store.view())} == {"n"}


def test_views_write_nothing_and_compaction_cleans_up(spark, folder):
    store = new_store(spark, folder, broadcast_rows=1)
    store.append(frame(spark, random_events(41)[:200]))
    store.compact()
    store.append(frame(spark, random_events(41)[200:]))
    there = sorted(files.names(spark, store.root))
    for _ in range(2):
        store.view()
    assert sorted(files.names(spark, store.root)) == there
    store.compact()
    assert files.names(spark, f"{store.root}/drafts") == []
    assert docs(store.view()) == wanted(random_events(41), store.policy)


def test_drops_are_read_from_their_partition_alone(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, random_events(42)))
    plan = store.log().where(F.col("index_name") == "__control")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(index_name" in plan


# -- rebuild -----------------------------------------------------------------------------------------


def in_database(spark, values):
    data = [(d, c, u, (v, {})) for d, c, u, v in values]
    return spark.createDataFrame(
        data, "database string, collection string, uid string, doc struct<value:bigint,ext:map<string,array<string>>>")


def test_reindex_clears_its_databases_only(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, [(1, "insert", "db0", "c2", "a", 1, {}), (2, "insert", "db1", "c2", "a", 2, {}),
                               (3, "insert", "db1", "c0", "b", 3, {}), (4, "insert", "db0", "c0", "b", 4, {})]))
    reindex(in_database(spark, [("db0", "c0", "n", 9), ("db1", "c0", "x", 8)]), ["c0", "c2"], "db0")(store)
    assert {k: v[0] for k, v in docs(store.view()).items()} == {
        ("db1", "c2", "a"): 2, ("db1", "c0", "b"): 3, ("db0", "c0", "n"): 9}


def test_rebuild_with_shared_keys_keeps_the_last_document(spark, folder):
    store = new_store(spark, folder, ApplyPolicy(key="index"))
    store.append(frame(spark, [(1, "insert", "db0", "c0", "k", 1, {}), (2, "insert", "db1", "c0", "m", 2, {})]))
    source = in_database(spark, [("db0", "c0", "k", 5), ("db1", "c0", "k", 6), ("db0", "c0", "m", 7), ("db0", "c0", None, 0), ("db0", "c0", "", 0)])
    reindex(source, ["c0"], ["db0", "db1"])(store)
    assert {k[2]: v[0] for k, v in docs(store.view()).items()} == {"k": 6, "m": 7}
    assert sorted((r.uid or "", r.reason) for r in store.rejects().collect()) == [("", "missing_key")] * 2
    backfill(in_database(spark, [("db1", "c0", "m", 8)]))(store)
    assert {k[2]: (k[0], v[0]) for k, v in docs(store.view()).items()} == {"k": ("db1", 6), "m": ("db1", 8)}
    assert store.view().documents.count() == 2


def write_files(spark, events, path, files, by):
    for i in range(files):
        part = [e for j, e in enumerate(events) if by(j, e) == i]
        frame(spark, part).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("order", ["in order", "shuffled"])
def test_stream_equals_batch(spark, folder, order):
    events, path = random_events(25), folder("feed")
    by = (lambda j, e: j * 4 // len(events)) if order == "in order" else (lambda j, e: e[0] % 4)
    write_files(spark, events, path, 4, by)
    store = new_store(spark, folder)
    schema = frame(spark, []).schema
    service = IndexService(store, lambda: stream_table(spark, path, schema, 1), COLLECTIONS)
    service.drain()
    assert docs(store.view()) == wanted(events, store.policy)


def test_stream_restarts_and_pauses_for_actions(spark, folder):
    events, path = random_events(26), folder("feed")
    schema = frame(spark, []).schema
    store = new_store(spark, folder)

    def service():
        return IndexService(store, lambda: stream_table(spark, path, schema), COLLECTIONS,
                            commit_delay="200 milliseconds", files_per_index=2)

    frame(spark, events[:150]).write.mode("append").parquet(path)
    service().drain()
    frame(spark, events[150:300]).write.mode("append").parquet(path)
    with service() as running:
        running.drain()
        assert docs(store.view()) == wanted(events[:300], store.policy)
        assert running.execute(lambda s: s.compact()).version == 1
        assert running.query is not None and running.query.isActive
        with pytest.raises(RuntimeError):
            running.execute(failing)
        assert running.query.isActive, "the feed resumes after a failed action"
        frame(spark, events[300:]).write.mode("append").parquet(path)
        running.drain()
    assert running.query is None
    assert docs(store.view()) == wanted(events, store.policy)


def failing(store):
    raise RuntimeError("no")


def test_json_event_stream(spark, folder):
    path = folder("json")
    events = [
        {"seq": 1, "operationType": "insert", "ns": {"db": "db0", "coll": "c0"},
         "documentKey": {"_id": {"$oid": "a" * 24}}, "fullDocument": {"value": 4}},
        {"seq": 2, "operationType": "insert", "ns": {"db": "db0", "coll": "other"},
         "documentKey": {"_id": "b"}, "fullDocument": {"value": 5}},
        {"seq": 3, "operationType": "rename", "ns": {"db": "db0", "coll": "c0"}, "documentKey": {"_id": "b"}},
        {"seq": 4, "operationType": "dropDatabase", "ns": {"db": "db1"}},
    ]
    spark.createDataFrame([(json.dumps(e),) for e in events], "value string").write.text(path)
    schema = spark.createDataFrame([], "doc struct<value:bigint>").schema["doc"].dataType
    config = IndexConfig(rules={"c0": [FieldRule("value", "value", m.to_long)]}, schemas={"c0": schema})
    store = IndexStore(spark, folder("store"), config, spark.createDataFrame([], "doc string").schema["doc"].dataType)
    IndexService(store, lambda: stream_events(spark, path), ["c0"]).drain()
    assert [(r._id, r.value) for r in store.view().documents.collect()] == [("a" * 24, 4)]
    assert {(r.seq, r.reason) for r in store.rejects().collect()} == {(3, "unknown_op")}


def test_export_of_net_changes(spark, folder):
    columns = "index_name string, _id string, value bigint"  # keys of one namespace
    old = spark.createDataFrame([("i", "same", 1), ("i", "changed", 1), ("i", "gone", 1)], columns)
    new = spark.createDataFrame([("i", "same", 1), ("i", "changed", 2), ("i", "new", 3)], columns)
    rows = actions(old, new)
    got = {(r.uid, r.action, r.body) for r in rows.collect()}
    assert got == {("changed", "update", '{"value":2}'), ("gone", "delete", None), ("new", "index", '{"value":3}')}
    path = folder("actions")
    write_actions(rows, path)
    assert spark.read.json(path).count() == 3
    target = folder("sent")

    def send(batch):
        import os
        import uuid
        os.makedirs(target, exist_ok=True)
        with open(f"{target}/{uuid.uuid4().hex}", "w") as out:
            out.writelines(json.dumps(r) + "\n" for r in batch)

    push(rows, send)
    assert spark.read.json(target).count() == 3


@pytest.mark.parametrize("key", ["namespace", "index"])
def test_export_follows_the_document_key(spark, folder, key):
    policy = ApplyPolicy(key=key)
    events = random_events(43)
    store = new_store(spark, folder, policy)
    states = []
    for part in (events[:200], events[200:230], events[230:]):
        store.append(frame(spark, part))
        states.append(docs(store.version(store.compact().version)))
    for old, new in ((1, 2), (2, 3), (1, 3)):
        state = dict(states[old - 1])
        key_of = (lambda d, c, u: (d, c, u)) if key == "namespace" else (lambda d, c, u: (route(d, c), u))
        state = {key_of(*k): (k, v) for k, v in state.items()}
        rows = store.changes(old, new).collect()
        assert len({(r.index_name, r.database, r.collection, r.uid) for r in rows}) == len(rows)
        for r in rows:
            at = key_of(r.database, r.collection, r.uid)
            assert (r.action == "index") == (at not in state)
            if r.action == "delete":
                del state[at]
            else:
                body = json.loads(r.body)
                state[at] = ((r.database, r.collection, r.uid), (body.get("value"), body["ext"]))
        assert dict(state.values()) == states[new - 1]


def test_export_can_clear_and_add_fields(spark):
    names = "index_name string, _id string, _collection string, _database string"
    old = spark.createDataFrame([("i", "a", "c", "d", 1, "x")], f"{names}, value bigint, gone string")
    new = spark.createDataFrame([("i", "a", "c", "d", None, 2)], f"{names}, value bigint, added bigint")
    assert actions(old, new, ApplyPolicy(nulls="keep")).first().body == '{"_collection":"c","_database":"d","value":null,"added":2,"gone":null}'
    assert actions(old, old, ApplyPolicy()).count() == 0
    one, two = ({"k": ["1"], "l": ["2"]}, {"l": ["2"], "k": ["1"]})
    frames = [spark.createDataFrame([("i", "a", "c", "d", e)], f"{names}, ext map<string,array<string>>") for e in (one, two)]
    assert actions(*frames).count() == 0


def test_catalog_table(spark, folder):
    df = spark.createDataFrame([("i", "a", 1), ("j", "b", 2)], "index_name string, _id string, value bigint")
    save_table(df, "foldex_index", buckets=2, path=folder("table"))
    back = spark.table("foldex_index")
    assert sorted((r.index_name, r._id, r.value) for r in back.collect()) == [("i", "a", 1), ("j", "b", 2)]
    plan = back.groupBy("_id").agg(F.sum("value"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("drop table foldex_index")
