"""The fold against sequential replay, for the policy combinations."""

import itertools

import pytest
from pyspark.sql import functions as F
from replay import orphan_updates, random_events, replay, route

from foldex.functions.running import last_before, order_ranges, running_max
from foldex.model import EMBEDDED, FULL_REPLACE, PARTIAL_UPDATE, ApplyPolicy
from foldex.operators import rejects as R
from foldex.operators.fold import allow_collections, apply_changes, clear_collections, fold_keys

SCHEMA = ("seq bigint, op string, database string, collection string, uid string, value bigint,"
          " ext map<string,array<string>>")
BASE_SCHEMA = ("uid string, collection string, database string, index_name string, seq bigint, value bigint,"
               " ext map<string,array<string>>")


def route_column(database, collection):
    return F.when(collection != "c2", F.concat(collection, F.lit("_shared"))).otherwise(
        F.concat(database, F.lit("_"), collection))


def base_docs():
    docs = []
    for database, collection, i in itertools.product(["db0", "db1"], ["c0", "c1", "c2"], range(6)):
        if database == "db1":
            continue  # keys of one index must be unique in a base
        uid = f"u{i}"
        docs.append((database, collection, uid, -i, {"y": [f"base{i}"], "z": ["kept"]}))
    return docs


def as_base(spark, docs):
    rows = [(u, c, d, route(d, c), -1, v, e) for d, c, u, v, e in docs]
    return spark.createDataFrame(rows, BASE_SCHEMA)


def result(df, policy):
    out = {}
    for r in df.collect():
        key = (r.database, r.collection, r.uid) if policy.key == "namespace" else (r.index_name, r.uid)
        assert key not in out, "one row per key"
        assert r.index_name == route(r.database, r.collection)
        out[key] = (r.database, r.collection, r.uid, r.value, dict(r.ext or {}))
    return out


DROPS = [("namespace", "database"), ("collection", "all"), ("namespace", "ignore")]
CASES = [
    (update, key, scope, database, with_base)
    for i, (update, key, (scope, database)) in enumerate(
        itertools.product(["replace", "merge", "ignore"], ["namespace", "index"], DROPS))
    for with_base in ([False, True] if i % 3 == 0 else [i % 2 == 0])
]


@pytest.mark.parametrize("update,key,scope,database,with_base", CASES)
def test_fold_equals_replay(spark, update, key, scope, database, with_base):
    policy = ApplyPolicy(update=update, key=key, drop_scope=scope, drop_database=database)
    events = random_events(CASES.index((update, key, scope, database, with_base)))
    docs = base_docs() if with_base else []
    base = as_base(spark, docs) if with_base else None
    df = spark.createDataFrame(events, SCHEMA).repartition(3)
    got = result(apply_changes(df, policy, route_column, base), policy)
    assert got == replay(events, policy, docs)


@pytest.mark.parametrize("policy", [EMBEDDED, FULL_REPLACE, PARTIAL_UPDATE])
def test_presets_equal_replay_beyond_the_broadcast_bound(spark, policy):
    events = random_events(11)
    docs = base_docs()
    df = spark.createDataFrame(events, SCHEMA).repartition(3)
    got = result(apply_changes(df, policy, route_column, as_base(spark, docs), broadcast_rows=1), policy)
    assert got == replay(events, policy, docs)


@pytest.mark.parametrize("policy", [ApplyPolicy(), ApplyPolicy(update="merge"), FULL_REPLACE])
def test_live_keys_need_no_documents(spark, policy):
    events = random_events(5)
    df = spark.createDataFrame(events, SCHEMA)
    got = {(r.database, r.collection, r.uid) for r in fold_keys(df, policy, route_column).collect()}
    assert got == {d[:3] for d in replay(events, policy).values()}


def test_replay_is_idempotent(spark):
    events = random_events(3)
    policy = ApplyPolicy(update="merge")
    once = spark.createDataFrame(events, SCHEMA)
    twice = once.unionByName(once).repartition(5)
    assert result(apply_changes(twice, policy, route_column), policy) == replay(events, policy)


def test_hot_key_is_combined_before_the_shuffle(spark):
    rows = spark.range(20000).select(
        F.col("id").alias("seq"), F.lit("insert").alias("op"), F.lit("db").alias("database"),
        F.lit("c").alias("collection"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("uid"),
        (F.col("id") * 2).alias("value"),
    )
    for policy, step in ((ApplyPolicy(), "row_number(), 1, Partial"), (ApplyPolicy(update="merge"), "partial_max_by")):
        df = apply_changes(rows, policy)
        assert step in df._jdf.queryExecution().executedPlan().toString()
        assert df.where("uid = 'hot'").first().value == 2 * 19998


def test_allow_list(spark):
    events = spark.createDataFrame(random_events(2), SCHEMA)
    short = allow_collections(events, ["c0", "c1"])
    long = allow_collections(events, spark.createDataFrame([("c0",), ("c1",)], "collection string"))
    want = events.where("collection in ('c0','c1') or op = 'drop_database'")
    seqs = sorted(r.seq for r in want.collect())
    assert sorted(r.seq for r in short.collect()) == seqs
    assert sorted(r.seq for r in long.collect()) == seqs


def test_clear_collections(spark):
    base = as_base(spark, base_docs())
    pairs = [("db0", "c0"), ("db1", "c2")]
    listed = clear_collections(base, pairs)
    joined = clear_collections(base, spark.createDataFrame(pairs, "database string, collection string"))
    assert listed.count() == joined.count() == 12
    assert {(r.database, r.collection) for r in listed.collect()}.isdisjoint(pairs)


@pytest.mark.parametrize("key", ["namespace", "index"])
@pytest.mark.parametrize("scope,database", DROPS)
def test_updates_without_target(spark, scope, database, key):
    policy = ApplyPolicy(update="merge", key=key, drop_scope=scope, drop_database=database)
    events = random_events(7, n=250)
    docs = base_docs()[:3]
    df = spark.createDataFrame(events, SCHEMA)
    found = R.updates_without_target(df, policy, route_column, as_base(spark, docs))
    assert sorted(r.seq for r in found.collect()) == orphan_updates(events, policy, docs)


def test_running_max_over_a_hot_key(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("k"), F.col("id") % 7)).otherwise("hot").alias("k"),
        F.col("id").alias("o"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"))
    out = running_max(rows, ["k"], "o", {"m": F.when(F.col("v") < 500, F.col("v"))},
                      order_ranges(rows, "o", 16)).collect()
    best = {}
    for r in sorted(out, key=lambda r: r.o):
        assert r.m == best.get(r.k)
        if r.v < 500:
            best[r.k] = max(best.get(r.k, -1), r.v)
    assert len(out) == 5000


def test_last_before_over_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("k"), F.col("id") % 7)).otherwise("hot").alias("k"),
        F.col("id").alias("o"))
    marks = rows.where("o % 97 = 3")
    ranges = order_ranges(rows, "o", 16)
    out = last_before(rows, marks, ["k"], "o", "m", ranges).collect()
    last = {}
    for r in sorted(out, key=lambda r: r.o):
        assert r.m == last.get(r.k)
        if r.o % 97 == 3:
            last[r.k] = r.o
    assert len(out) == 3000


def test_rejected_rows(spark):
    rows = [
        (1, "insert", "db", "c", "a" * 24, 1, {}),
        (2, "rename", "db", "c", "a" * 24, 1, {}),
        (3, "insert", "db", "c", None, 1, {}),
        (4, "delete", "db", None, "b" * 24, None, None),
        (5, "insert", "db", "c", "not-hex", 1, {}),
        (6, "drop", "db", "c", None, None, None),
        (7, "drop_database", "db", None, None, None, None),
        (None, "insert", "db", "c", "a" * 24, 1, {}),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.seq: r.reason for r in R.rejected(df, key_pattern=R.OBJECT_ID).collect()}
    assert got == {2: "unknown_op", 3: "missing_key", 4: "missing_namespace", 5: "malformed_key", None: "missing_seq"}
    assert sorted(r.seq for r in R.accepted(df, key_pattern=R.OBJECT_ID).collect()) == [1, 6, 7]
    late = {r.seq: r.reason for r in R.rejected(df, as_of=6, key_pattern=R.OBJECT_ID).collect()}
    assert late[1] == late[6] == "late" and 7 not in late


def test_sequence_conflicts(spark):
    rows = [
        (1, "insert", "db0", "c0", "u", 1, {}), (1, "insert", "db0", "c0", "u", 1, {}),
        (2, "insert", "db0", "c0", "u", 1, {}), (2, "delete", "db0", "c0", "u", None, None),
        (3, "insert", "db1", "c0", "u", 1, {"x": ["1"]}), (3, "insert", "db1", "c0", "u", 1, {"x": ["2"]}),
    ]
    assert sorted(r.seq for r in R.sequence_conflicts(spark.createDataFrame(rows, SCHEMA)).collect()) == [2, 3]


@pytest.mark.parametrize("seed", range(30, 36))
@pytest.mark.parametrize("scope,database", DROPS)
def test_merging_into_shared_keys_equals_replay(spark, seed, scope, database):
    policy = ApplyPolicy(update="merge", key="index", drop_scope=scope, drop_database=database)
    events = random_events(seed, n=600)
    docs = base_docs() if seed % 2 else []
    base = as_base(spark, docs) if docs else None
    df = spark.createDataFrame(events, SCHEMA).repartition(3)
    got = result(apply_changes(df, policy, route_column, base, broadcast_rows=1 if seed % 3 == 0 else 1000), policy)
    assert got == replay(events, policy, docs)
