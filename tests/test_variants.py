"""Paths over documents without a schema: against plain Python on random documents, and the strict checks."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex import ApplyPolicy, FieldRule, IndexConfig, IndexStore, index_documents, project
from foldex.functions import mappers as m
from foldex.functions import variants
from foldex.operators import rejects as R

PATHS = ["a", "b", "a.b", "b.a", "a.b.c", "b.a.b", "a.b.a.c", "c.c.c.c", "a b.x'y", 'q"t']
KINDS = {"string": (str, m.to_string, m.to_string_list), "bigint": (int, m.to_long, m.to_long_list),
         "double": ((int, float), m.to_double, m.to_double_list), "boolean": (bool, m.to_boolean, m.to_boolean_list)}


def document(rng, depth=0):
    """A random document of few names: values, nulls, documents, and arrays of any of these."""
    def value(level):
        kind = rng.random()
        if kind < 0.3 and level < 4:
            return document(rng, level + 1)
        if kind < 0.6 and level < 4:
            return [value(level + 1) for _ in range(rng.randint(0, 3))]
        return rng.choice(["s", "", 7, -1, 2.5, True, False, None, "5"])
    names = ["a", "b", "c", "a b", "x'y", 'q"t']
    return {n: value(depth) for n in rng.sample(names, rng.randint(0, 4))}


def of_kind(value, kind):
    if isinstance(value, bool):
        return value if kind == "boolean" else None
    return value if isinstance(value, KINDS[kind][0]) else None


def plain_scalar(doc, path, kind):
    for step in path.split("."):
        doc = doc.get(step) if isinstance(doc, dict) else None
    return of_kind(doc, kind)


def plain_leaves(doc, path):
    *inner, last = path.split(".")
    reached = [doc]
    for step in inner:
        found = [d.get(step) for d in reached if isinstance(d, dict)]
        reached = [x for f in found for x in (f if isinstance(f, list) else [f])]
    out = []
    for d in reached:
        value = d.get(last) if isinstance(d, dict) else None
        out += value if isinstance(value, list) else [] if value is None else [value]
    return out


def plain_list(doc, path, kind):
    if "." in path:
        found = plain_leaves(doc, path)
    else:
        found = doc.get(path)
        if not isinstance(found, list):
            return None
    return [of_kind(v, kind) for v in found]


def plain_wrong(doc, path, kind, multi):
    wrong = lambda v: v is not None and of_kind(v, kind) is None
    if not multi:
        for step in path.split("."):
            doc = doc.get(step) if isinstance(doc, dict) else None
        return wrong(doc)
    if "." in path:
        return any(map(wrong, plain_leaves(doc, path)))
    value = doc.get(path)
    return value is not None and (not isinstance(value, list) or any(map(wrong, value)))


@pytest.fixture(scope="module")
def parsed(spark):
    rng = random.Random(11)
    docs = [document(rng) for _ in range(300)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, j string")
    return docs, df.select("i", F.try_parse_json("j").alias("doc"))


@pytest.mark.parametrize("kind", list(KINDS))
def test_values_equal_plain_ones(parsed, kind):
    docs, df = parsed
    _, scalar, many = KINDS[kind]
    columns = [mapper.compile(F.col("doc"), T.VariantType(), p).value.alias(f"{n}{k}")
               for n, mapper in (("s", scalar), ("l", many)) for k, p in enumerate(PATHS)]
    wrong = [variants.mismatch(F.col("doc"), p, scalar.data_type, multi).alias(f"w{int(multi)}{k}") for k, p in enumerate(PATHS) for multi in (False, True)]
    for row in df.select("i", *columns, *wrong).collect():
        doc = docs[row.i]
        for k, path in enumerate(PATHS):
            assert row[f"s{k}"] == plain_scalar(doc, path, kind), (doc, path)
            assert row[f"l{k}"] == plain_list(doc, path, kind), (doc, path)
            for multi in (False, True):
                assert row[f"w{int(multi)}{k}"] == plain_wrong(doc, path, kind, multi), (doc, path, multi)


def test_a_store_without_schemas(spark, folder):
    """Collections with and without a schema side by side; unreadable and mistyped documents are rejected, others go on."""
    rules = (FieldRule("n", "n", m.to_long), FieldRule("parts.tag", "tags", m.to_string_list, default="none"))
    schema = T.StructType().add("n", T.LongType()).add("parts", T.ArrayType(T.StructType().add("tag", T.StringType())))
    config = IndexConfig(rules={"free": rules, "fixed": rules}, schemas={"fixed": schema}, strict_types=True)
    store = IndexStore(spark, folder("store"), config, T.StringType(), ApplyPolicy())
    rows = []
    for k, collection in enumerate(("free", "fixed")):
        texts = ['{"n": {"$numberLong": "5"}, "parts": [{"tag": "x"}, {}, {"tag": "y"}]}', '{"n": 6}', '{"n": 7, "parts": [{"tag": 1}]}', "[1]", "{", "5", "null"]
        rows += [(k * 10 + i, "insert", "db", collection, f"u{i}", t) for i, t in enumerate(texts)]
    store.append(spark.createDataFrame(rows, "seq bigint, op string, database string, collection string, uid string, doc string"))
    got = {(r._collection, r._id): (r.n, r.tags) for r in store.view().documents.collect()}
    assert got == {(c, u): v for c in ("free", "fixed") for u, v in (("u0", (5, ["x", "y"])), ("u1", (6, ["none"])))}
    reasons = {(r.collection, r.uid, r.reason) for r in store.rejects().collect()}
    assert reasons == {(c, u, r) for c in ("free", "fixed") for u, r in (
        ("u2", "type_mismatch"), ("u3", "unreadable_document"), ("u4", "unreadable_document"), ("u5", "unreadable_document"), ("u6", "unreadable_document"))}


def test_variant_columns_and_no_python(spark):
    df = spark.range(3).select(F.lit("db").alias("database"), F.lit("c").alias("collection"), F.col("id").cast("string").alias("uid"),
                               F.parse_json(F.concat(F.lit('{"a": {"b": ['), "id", F.lit("]}}"))).alias("doc"))
    config = IndexConfig(rules={"c": (FieldRule("a.b", "b", m.to_long_list), FieldRule("a.b", "none", m.to_long))})
    out = index_documents(project(df, config))
    assert sorted((r._id, tuple(r.b), r.none) for r in out.collect()) == [(str(i), (i,), None) for i in range(3)]
    assert "Python" not in out._jdf.queryExecution().toString()
    assert R.type_mismatches(df.withColumns({"seq": F.col("uid").cast("bigint"), "op": F.lit("insert")}), config).count() == 3
