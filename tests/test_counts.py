"""Counts that follow a store's versions."""

import pytest
from pyspark.sql import functions as F
from replay import random_events
from test_fold import route_column
from test_late import frame

from foldex import ApplyPolicy, FieldRule, IndexConfig, IndexStore
from foldex.functions import mappers as m
from foldex.plans import files
from foldex.plans.counts import MaintainedCounts

RULES = [FieldRule("value", "value", m.to_long), FieldRule("value", "odd", m.to_long)]
CONFIG = IndexConfig(rules={c: RULES for c in ("c0", "c1", "c2")}, route=route_column, facets=("_collection", "odd"),
                     facets_by_index={"db0_c2": ("odd",)})


def new_store(spark, folder, policy, config=CONFIG, **kw):
    return IndexStore(spark, folder("store"), config, frame(spark, []).schema["doc"].dataType, policy, **kw)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same(counts, view):
    assert rows(counts.sizes()) == rows(view.sizes())
    assert rows(counts.index_counts()) == rows(view.index_counts())
    assert rows(counts.facets()) == rows(view.facets())
    assert rows(counts.facets(collection="c0")) == rows(view.where(F.col("_collection") == "c0").facets())


@pytest.mark.parametrize("policy, late", [(ApplyPolicy(), None), (ApplyPolicy(key="index"), None), (ApplyPolicy(), 10**6)])
def test_counts_follow_updates_deletes_and_drops(spark, folder, policy, late):
    events = random_events(31, 240)
    if late:  # the later half first: its drops do not clear what comes after them
        events = events[120:] + events[:120]
    # Few values, so that facets go up and down.
    events = [(*e[:5], None if e[5] is None else e[5] % 3, *e[6:]) for e in events]
    store = new_store(spark, folder, policy, late=late)
    counts = MaintainedCounts(store, max_segments=2)
    assert counts.refresh().segments == () and rows(counts.sizes()) == []
    for part in range(4):
        store.append(frame(spark, events[part * 60: (part + 1) * 60]))
        store.compact()
        found = counts.refresh()
        assert len(found.segments) == (1, 2, 1, 2)[part] and counts.refresh() == found
        same(counts, store.view())
    counts.vacuum()
    assert len(files.names(spark, f"{counts.root}/segments")) == 2 and len(files.names(spark, f"{counts.root}/commits")) == 1
    same(counts, store.view())
    # What the log does not tell is counted afresh.
    store.clear("db0", "c0")
    assert len(counts.refresh().segments) == 1
    same(counts, store.view())
    assert counts.size("db0", "c0") == 0


def test_reading_counts_opens_no_bases(spark, folder):
    plain = IndexConfig(rules=CONFIG.rules, route=route_column)
    store = new_store(spark, folder, ApplyPolicy(), plain)
    store.append(frame(spark, [(1, "insert", "db0", "c0", "a", 1), (2, "insert", "db1", "c0", "b", 1), (3, "drop", "db0", "c0", None, None)]))
    store.compact()
    counts = MaintainedCounts(store)
    counts.refresh()
    assert rows(counts.sizes()) == [("db1", "c0", 1)] and counts.size("db1", "c0") == 1
    assert rows(counts.facets()) == []
    assert all("/counts/segments/" in f for f in counts.sizes().inputFiles())
