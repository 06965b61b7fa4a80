"""Late changes folded into the place they belong to."""

import random

import pytest
from pyspark.sql import functions as F
from replay import random_events, replay, route
from test_fold import route_column

from foldex import ApplyPolicy, FieldRule, IndexConfig, IndexStore
from foldex.functions import mappers as m
from foldex.plans import files
from foldex.plans.rebuild import reindex

SCHEMA = "seq bigint, op string, database string, collection string, uid string, doc struct<value:bigint>"
CONFIG = IndexConfig(
    rules={c: [FieldRule("value", "value", m.to_long)] for c in ("c0", "c1", "c2")}, route=route_column, facets=("_collection",))
POLICIES = [
    ApplyPolicy(), ApplyPolicy(update="ignore"), ApplyPolicy(update="merge"), ApplyPolicy(key="index"),
    ApplyPolicy(update="ignore", key="index", drop_scope="collection", drop_database="all"),
    ApplyPolicy(update="merge", drop_scope="collection"),
]


def frame(spark, events):
    return spark.createDataFrame([(*e[:5], None if e[5] is None else (e[5],)) for e in events], SCHEMA)


def plain(events):
    """Replay's events without extended fields."""
    return [(*e[:6], {} if e[6] is not None else None) for e in events]


def new_store(spark, folder, policy, late, root=None, **kw):
    return IndexStore(spark, root or folder("store"), CONFIG, frame(spark, []).schema["doc"].dataType, policy, late=late, **kw)


def docs(view):
    return sorted((r._database, r._collection, r._id, r.value) for r in view.documents.collect())


def wanted(events, policy):
    return sorted(d[:4] for d in replay(plain(events), policy).values())


@pytest.mark.parametrize("number, broadcast_rows", [(0, 1), (1, 100_000), (2, 1), (2, 100_000), (3, 1), (4, 100_000), (5, 1)])
def test_any_order_gives_what_replay_gives(spark, folder, number, broadcast_rows):
    policy, events = POLICIES[number], random_events(50 + number, 240)
    store = new_store(spark, folder, policy, 10**6, broadcast_rows=broadcast_rows)
    dealt = random.Random(number).sample(events, len(events))
    for part in range(3):
        store.append(frame(spark, dealt[part * 80: (part + 1) * 80]))
        assert docs(store.view()) == wanted(dealt[: (part + 1) * 80], policy)
        if part < 2:
            store.compact()
            assert docs(store.view()) == docs(store.version(part + 1)) == wanted(dealt[: (part + 1) * 80], policy)
    name = route("db0", "c0")
    assert docs(store.view(name)) == sorted(d for d in wanted(events, policy) if route(*d[:2]) == name)
    assert store.rejects().where("reason = 'late'").isEmpty()


@pytest.mark.parametrize("number", [0, 2, 4])
def test_only_changes_below_the_bound_are_rejected(spark, folder, number):
    policy, late = POLICIES[number], 700
    events = random_events(70 + number, 320)
    store, rng = new_store(spark, folder, policy, late), random.Random(number)
    # Each event comes up to 1,500 numbers late, so some miss the bound.
    dealt = sorted(events, key=lambda e: e[0] + rng.choice([0, 0, rng.randrange(1500)]))
    taken, top, missed = [], -1, []
    for part in range(4):
        batch = dealt[part * 80: (part + 1) * 80]
        missed += [e[0] for e in batch if e[0] < top - late]
        taken += [e for e in batch if e[0] >= top - late]
        store.append(frame(spark, batch))
        store.compact()
        top = max(e[0] for e in taken)
        assert docs(store.view()) == wanted(taken, policy)
    assert missed and sorted(r.seq for r in store.rejects().where("reason = 'late'").collect()) == sorted(missed)


def test_tombstones_and_drops_are_forgotten_below_the_bound(spark, folder):
    store = new_store(spark, folder, ApplyPolicy(), 100)
    store.append(frame(spark, [(1, "insert", "db0", "c0", "a", 1), (2, "delete", "db0", "c0", "a", None),
                               (3, "insert", "db0", "c0", "b", 1), (4, "drop", "db0", "c0", None, None),
                               (50, "insert", "db0", "c0", "c", 3), (60, "delete", "db0", "c0", "d", None)]))
    store.compact()
    head = store.head()
    assert sorted(r.uid for r in store._base_scan(head, None).collect()) == ["a", "b", "c", "d"]
    assert store.spark.read.parquet(f"{store.root}/drops/{head.drops}").count() == 1
    # Below the drop, below the tombstone, and above both.
    store.append(frame(spark, [(3 + 0, "insert", "db0", "c0", "e", 9), (55, "insert", "db0", "c0", "d", 9), (58, "insert", "db0", "c0", "f", 9)]))
    assert docs(store.view()) == [("db0", "c0", "c", 3), ("db0", "c0", "f", 9)]
    store.append(frame(spark, [(155, "insert", "db0", "c0", "g", 5)]))
    store.compact()
    head = store.head()
    assert sorted(r.uid for r in store._base_scan(head, None).collect()) == ["c", "d", "f", "g"]
    assert store.spark.read.parquet(f"{store.root}/drops/{head.drops}").isEmpty()
    store.compact()
    store.vacuum(keep=1)
    assert len(files.names(spark, f"{store.root}/drops")) == 1
    assert docs(store.view()) == [("db0", "c0", "c", 3), ("db0", "c0", "f", 9), ("db0", "c0", "g", 5)]


def test_other_commits_close_the_past(spark, folder):
    store = new_store(spark, folder, ApplyPolicy(), 1000)
    store.append(frame(spark, [(10, "insert", "db0", "c0", "a", 1), (20, "insert", "db0", "c1", "b", 2)]))
    store.compact()
    snapshot = frame(spark, [(0, "insert", "db0", "c0", "z", 7)]).select("database", "collection", "uid", "doc")
    reindex(snapshot, ["c0"], "db0")(store)
    assert docs(store.view()) == [("db0", "c0", "z", 7), ("db0", "c1", "b", 2)]
    store.append(frame(spark, [(5, "insert", "db0", "c0", "late", 1), (21, "update", "db0", "c0", "z", 8)]))
    assert docs(store.view()) == [("db0", "c0", "z", 8), ("db0", "c1", "b", 2)]
    assert [(r.seq, r.reason) for r in store.rejects().collect()] == [(5, "late")]
    store.upsert(snapshot.withColumn("doc", F.struct(F.lit(11).cast("bigint").alias("value"))))
    store.compact()
    # Above the rebuild, below the document from outside the feed; then above both.
    store.append(frame(spark, [(21, "update", "db0", "c0", "z", 9)]))
    assert docs(store.view()) == [("db0", "c0", "z", 11), ("db0", "c1", "b", 2)]
    store.append(frame(spark, [(22, "delete", "db0", "c0", "z", None)]))
    assert docs(store.view()) == [("db0", "c1", "b", 2)]
    store.drop_all()
    assert docs(store.view()) == []


def test_what_cannot_be_folded_late_is_refused(spark, folder):
    with pytest.raises(ValueError):
        new_store(spark, folder, ApplyPolicy(update="merge", key="index"), 10)
    store = new_store(spark, folder, ApplyPolicy(), None)
    store.append(frame(spark, [(1, "insert", "db0", "c0", "a", 1)]))
    store.compact()
    with pytest.raises(ValueError):
        new_store(spark, folder, ApplyPolicy(), 10, root=store.root).view()


def test_an_empty_store_and_empty_batches(spark, folder):
    store = new_store(spark, folder, ApplyPolicy(), 10)
    assert docs(store.view()) == []
    store.append(frame(spark, []))
    store.compact()
    assert docs(store.view()) == docs(store.version(1)) == []
    store.append(frame(spark, [(5, "insert", "db0", "c0", "a", 1)]))
    assert docs(store.view()) == [("db0", "c0", "a", 1)]
