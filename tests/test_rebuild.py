"""Rebuilds that write only what differs, what they report, and upserts that updates can rely on."""

import time

import pytest

from foldex import ApplyPolicy, FieldRule, IndexConfig, IndexStore
from foldex.functions import mappers as m
from foldex.plans import store as store_module
from foldex.plans.rebuild import RebuildMetrics, backfill, reindex, reindex_changed
from pyspark.sql import functions as F

DOC = "struct<n: bigint, tags: array<string>>"
RULES = (FieldRule("n", "n", m.to_long), FieldRule("tags", "tags", m.to_string_list))


def new_store(spark, folder, **policy):
    extend = lambda ctx: {"b": ctx.source["tags"], "a": F.array(ctx.collection)}
    config = IndexConfig(rules={"c0": RULES, "c1": RULES}, extender=extend)
    return IndexStore(spark, folder("store"), config, spark.createDataFrame([], f"doc {DOC}").schema["doc"].dataType, ApplyPolicy(**policy))


def snapshot(spark, rows):
    return spark.createDataFrame([(d, c, u, {"n": n, "tags": tags}) for d, c, u, n, tags in rows], f"database string, collection string, uid string, doc {DOC}")


def events(spark, rows):
    return spark.createDataFrame([(s, op, "db", "c0", u, None if n is None else {"n": n, "tags": []}) for s, op, u, n in rows],
                                 f"seq bigint, op string, database string, collection string, uid string, doc {DOC}")


def documents(store):
    return {(r._database, r._collection, r._id): (r.n, r.tags and tuple(r.tags), tuple(sorted((k, tuple(v)) for k, v in r.ext.items())))
            for r in store.view().documents.collect()}


def test_a_rebuild_writes_what_differs(spark, folder):
    store, other = new_store(spark, folder), new_store(spark, folder)
    before = [("db", "c0", f"u{i}", i, ["x", None] if i % 2 else None) for i in range(40)] + [("db", "c1", "u1", 1, []), ("db2", "c0", "u1", 1, [])]
    after = [r for r in before if r[2] != "u5"] + [("db", "c0", "new", None, ["y"]), ("db", "c0", "", 1, []), ("db", "c0", None, 1, [])]
    after = [(d, c, u, -1 if u == "u6" else n, ["z"] if u == "u7" else t) for d, c, u, n, t in after]
    for s in (store, other):
        backfill(snapshot(spark, before))(s)
        s.append(events(spark, [(1, "update", "u8", 88), (2, "delete", "u9", None), (3, "insert", "u50", 50)]))
    batch = reindex_changed(snapshot(spark, after), ["c0"], "db")(store)
    written = {(r.op, r.uid) for r in store.log([batch]).collect()}
    assert written == {("insert", u) for u in ("new", "u6", "u7", "u8", "u9")} | {("delete", u) for u in ("u5", "u50")}
    reindex(snapshot(spark, after), ["c0"], "db")(other)
    assert documents(store) == documents(other)
    assert reindex_changed(snapshot(spark, after), ["c0"], "db")(store) is None
    store.append(events(spark, [(4, "update", "u6", 66)]))
    store.compact()
    assert documents(store)[("db", "c0", "u6")][0] == 66 and store.rejects().count() == 0
    assert reindex_changed(snapshot(spark, []), ["c1"], ["db", "db2"])(store)
    assert ("db", "c1", "u1") not in documents(store) and ("db2", "c0", "u1") in documents(store)
    with pytest.raises(ValueError):
        reindex_changed(snapshot(spark, after), ["c0"], "db")(new_store(spark, folder, key="index"))


def test_rebuilds_report_what_passes(spark, folder):
    store, metrics = new_store(spark, folder), RebuildMetrics(["c0", "c1", "none"])
    rows = [("db", "c0", "a", 1, []), ("db", "c0", None, 1, []), ("db", "c0", "", 1, []), ("db", "c1", "a", 1, []), ("db", "c2", "a", 1, [])]
    reindex(snapshot(spark, rows), metrics.collections, "db", metrics)(store)
    assert metrics.rows() == [("c0", 3, 1, 2), ("c1", 1, 1, 0), ("none", 0, 0, 0)]
    assert len(documents(store)) == 2


def test_upserts_are_targets_of_updates(spark, folder):
    store = new_store(spark, folder, update="merge")
    store.append(events(spark, [(1, "insert", "a", 1)]))
    store.upsert(snapshot(spark, [("db", "c0", "b", 1, [])]))
    store.append(events(spark, [(2, "update", "b", 2), (3, "update", "none", 2)]))
    for _ in range(3):
        assert {k[2]: v[0] for k, v in documents(store).items()} == {"a": 1, "b": 2}
        assert [(r.seq, r.uid, r.reason) for r in store.rejects().collect()] == [(3, "none", "update_without_target")]
        store.compact()


def test_upserts_come_last_whatever_the_clock(spark, folder, monkeypatch):
    store = new_store(spark, folder)
    store.append(events(spark, [(1, "insert", "a", 1)]))
    store.upsert(snapshot(spark, [("db", "c0", "a", 2, [])]))
    store.compact()
    now = time.time_ns()
    monkeypatch.setattr(store_module.time, "time_ns", lambda: now - 10**15)  # another driver, whose clock is behind
    for n in (3, 4):
        store.upsert(snapshot(spark, [("db", "c0", "a", n, [])]))
        assert documents(store)[("db", "c0", "a")][0] == n and store.rejects().count() == 0


def test_emptied_indices_leave_no_folder(spark, folder):
    from foldex.plans import files
    store = new_store(spark, folder)
    store.append(events(spark, [(1, "insert", "a", 1)]))
    store.compact()
    store.append(events(spark, [(2, "delete", "a", None)]))
    store.compact()
    assert store.head().bases == {} and documents(store) == {}
    store.drop_all()
    store.vacuum(keep=1)
    assert files.names(spark, f"{store.root}/bases") == []
