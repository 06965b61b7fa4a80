"""Small documents with known index values: mapping, defaults, combination, routing, facets."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex import (
    Analyzer,
    ApplyPolicy,
    FieldRule,
    IndexConfig,
    IndexView,
    MappingError,
    all_of,
    apply_changes,
    index_documents,
    project,
    stop_words,
)
from foldex.functions import mappers as m
from foldex.functions.mappers import TypeMismatch

CITY = "struct<name:string>"
DOC = f"name:string,tags:array<string>,cities:array<{CITY}>,ort:{CITY},created:timestamp,draft:boolean"
RULES = (
    FieldRule("name", "name", m.to_string, stored=True),
    FieldRule("tags", "tags", m.to_string_list, stored=True, keyword=True),
    FieldRule("cities.name", "cities", m.to_string_list, default=lambda: "K-Town", stored=True),
    FieldRule("ort.name", "cities", m.to_string, stored=True),
    FieldRule("created", "created", m.to_date, stored=True, date_format="yyyy-MM-dd"),
    FieldRule("draft", "draft", m.to_boolean, stored=True),
)


def tag_facet(ctx):
    return {"tag_facet": ctx.source["tags"]}


CONFIG = IndexConfig(
    rules={"dokumente": RULES}, extender=tag_facet, facets=("tag_facet",),
    analyzer=Analyzer(by_field={"name": Analyzer(stop_words=("der", "die"))}),
)
FULL = ("tilo", ["eins", "zwei"], [("Bochum",), ("Dortmund",), ("Essen",)], ("Kaiserslautern",),
        dt.datetime(2023, 9, 1, 23, 0), False)
PLAIN = ("lara", ["drei", "zwei"], None, None, None, True)


def rows(spark, *docs, collection="dokumente", ddl=DOC):
    data = [("search", collection, f"{i:024x}", d) for i, d in enumerate(docs)]
    return spark.createDataFrame(data, f"database string, collection string, uid string, doc struct<{ddl}>")


def first(spark, doc, config=CONFIG, policy=None, **kw):
    return index_documents(project(rows(spark, doc, **kw), config, policy or ApplyPolicy())).first()


def test_mapping_and_metadata(spark):
    r = first(spark, FULL)
    assert (r.index_name, r._id, r._collection, r._database) == ("dokumente", "0" * 24, "dokumente", "search")
    assert r.name == "tilo" and r.tags == ["eins", "zwei"]
    assert r.created == "2023-09-01" and r.draft == "false"
    assert first(spark, PLAIN).draft == "true"


def test_combined_rules_append(spark):
    assert first(spark, FULL).cities == ["Bochum", "Dortmund", "Essen", "Kaiserslautern"]


def test_combined_rules_last_wins(spark):
    last = ApplyPolicy(combine="last")
    assert first(spark, FULL, policy=last).cities == "Kaiserslautern"
    assert first(spark, PLAIN, policy=last).cities is None


def test_default_replaces_null_and_empty_list(spark):
    assert first(spark, PLAIN).cities == ["K-Town"]
    empty = ("x", None, [], None, None, None)
    assert first(spark, empty).cities == ["K-Town"]
    assert first(spark, empty, policy=ApplyPolicy(defaults=False)).cities == []
    config = IndexConfig(rules={"dokumente": [
        FieldRule("created", "created", m.to_date, default="never"),
        FieldRule("draft", "draft", m.to_boolean, default=True),
        FieldRule("tags", "tags", m.to_string_list, default=["a", "b"]),
        FieldRule("name", "name", m.to_string, default=lambda: F.concat(F.col("collection"), F.lit("!"))),
    ]})
    r = first(spark, (None, None, None, None, None, None), config)
    assert (r.created, r.draft, r.tags, r.name) == ("never", "true", ["a", "b"], "dokumente!")


def test_typed_values_without_text_rendering(spark):
    config = IndexConfig(rules=CONFIG.rules, text_values=False)
    r = first(spark, FULL, config)
    assert r.created == dt.datetime(2023, 9, 1, 23, 0) and r.draft is False


def test_null_elements(spark):
    doc = ("x", ["a", None, "b"], None, None, None, None)
    assert first(spark, doc).tags == ["a", "b"]
    assert first(spark, doc, policy=ApplyPolicy(nulls="keep")).tags == ["a", None, "b"]


def test_collection_without_rules_keeps_metadata(spark):
    r = first(spark, FULL, collection="bilder")
    assert r._collection == "bilder" and r.name is None and r.cities is None


def test_extender_runs_for_every_document(spark):
    assert first(spark, FULL).ext == {"tag_facet": ["eins", "zwei"]}
    assert first(spark, ("x", [], None, None, None, None)).ext == {}


def test_scalar_and_list_rules_share_an_index_field(spark):
    config = IndexConfig(rules={
        "dokumente": [FieldRule("tags", "labels", m.to_string_list)],
        "books": [FieldRule("name", "labels", m.to_string)],
    })
    both = rows(spark, FULL).unionByName(rows(spark, FULL, collection="books"))
    got = {r._collection: r.labels for r in index_documents(project(both, config)).collect()}
    assert got == {"dokumente": ["eins", "zwei"], "books": ["tilo"]}


def test_conflicting_types_fail_when_rules_compile(spark):
    config = IndexConfig(rules={
        "dokumente": [FieldRule("draft", "x", m.to_boolean)], "books": [FieldRule("name", "x", m.to_string)],
    }, text_values=False)
    with pytest.raises(MappingError):
        project(rows(spark, FULL), config)
    with pytest.raises(TypeMismatch):
        project(rows(spark, FULL), IndexConfig(rules={"dokumente": [FieldRule("nope", "x", m.to_string)]},
                                               strict_paths=True))


def test_json_documents(spark):
    schemas = {
        "dokumente": T.StructType().add("name", T.StringType()).add(
            "cities", T.ArrayType(T.StructType().add("name", T.StringType()))),
        "books": T.StructType().add("author", T.StringType()),
    }
    config = IndexConfig(rules={
        "dokumente": [FieldRule("name", "name", m.to_string), FieldRule("cities.name", "cities", m.to_string_list)],
        "books": [FieldRule("author", "name", m.to_string)],
    }, schemas=schemas)
    data = [
        ("db", "dokumente", "a", '{"name": "tilo", "cities": [{"name": "Bochum"}, {"x": 1}]}'),
        ("db", "books", "b", '{"author": "lem"}'),
        ("db", "books", "c", None),
    ]
    df = spark.createDataFrame(data, "database string, collection string, uid string, doc string")
    got = {r._id: (r.name, r.cities) for r in index_documents(project(df, config)).collect()}
    assert got == {"a": ("tilo", ["Bochum"]), "b": ("lem", None), "c": (None, None)}


@pytest.fixture(scope="module")
def view(spark):
    return IndexView(index_documents(project(rows(spark, FULL, PLAIN), CONFIG)).cache(), CONFIG)


def test_reads(view):
    assert view.size("search", "dokumente") == 2 and view.size("search", "bilder") == 0
    assert [tuple(r) for r in view.sizes().collect()] == [("search", "dokumente", 2)]
    assert [tuple(r) for r in view.index_counts().collect()] == [("dokumente", 2)]
    assert view.get("0" * 24).first().name == "tilo"
    assert view.stored().columns == ["index_name", "_id", "_collection", "_database", "name", "tags", "cities",
                                     "created", "draft"]


def test_facets(view):
    counts = {(r.dim, r.value): r.n for r in view.facets().collect()}
    assert counts == {("tag_facet", "eins"): 1, ("tag_facet", "zwei"): 2, ("tag_facet", "drei"): 1}
    hits = view.facets(all_of(view.term("_collection", "dokumente"), view.term("tags", "drei")))
    assert {(r.value, r.n) for r in hits.collect()} == {("drei", 1), ("zwei", 1)}


def test_predicates(view):
    def names(condition):
        return sorted(r.name for r in view.where(condition).documents.collect())

    assert names(view.term("tags", "zwei")) == ["lara", "tilo"]
    assert names(view.term("draft", "true")) == ["lara"]
    assert names(view.match("cities", "ESSEN und Bonn")) == ["tilo"]
    assert names(view.match("name", "der die")) == []
    assert names(all_of()) == ["lara", "tilo"]


def test_postings(spark):
    config = IndexConfig(rules={"dokumente": [FieldRule("name", "name", m.to_string)]})
    docs = [(t, None, None, None, None, None) for t in ("b a b", "", None, "A.c  B")]
    view = IndexView(index_documents(project(rows(spark, *docs), config)), config)
    got = sorted((r.term, int(r._id, 16), r.tf) for r in view.postings("name").collect())
    assert got == [("a", 0, 1), ("a", 3, 1), ("b", 0, 2), ("b", 3, 1), ("c", 3, 1)]


def test_stop_word_lists(spark):
    assert "und" in stop_words("german")


def changes(spark, *events):
    data = [(i, op, db, coll, uid, None if name is None else (name,)) for i, (op, db, coll, uid, name)
            in enumerate(events)]
    return spark.createDataFrame(
        data, "seq bigint, op string, database string, collection string, uid string, doc struct<name:string>")


NAMES = IndexConfig(rules={c: [FieldRule("name", "name", m.to_string)] for c in ("dokumente", "books")},
                    route=lambda database, collection: database)


def run(spark, *events, policy=None):
    policy = policy or ApplyPolicy()
    projected = project(changes(spark, *events), NAMES, policy).drop("index_name")
    docs = index_documents(apply_changes(projected, policy, NAMES.route))
    return {(r.index_name, r._collection, r._id): r.name for r in docs.collect()}


def test_two_collections_in_one_index(spark):
    two = [("insert", "s", "dokumente", "1", "tilo"), ("insert", "s", "books", "2", "lem")]
    assert run(spark, *two) == {("s", "dokumente", "1"): "tilo", ("s", "books", "2"): "lem"}
    assert run(spark, *two, ("drop", "s", "books", None, None)) == {("s", "dokumente", "1"): "tilo"}


def test_change_sequences(spark):
    a, b = ("insert", "s", "books", "1", "tilo"), ("insert", "s", "books", "2", "x")
    update = ("update", "s", "books", "1", "lara")
    delete = ("delete", "s", "books", "1", None)
    one, two = ("s", "books", "1"), ("s", "books", "2")
    assert run(spark, a, update) == {one: "lara"}
    assert run(spark, a, b, delete) == {two: "x"}
    assert run(spark, a, b, ("drop", "s", "books", None, None)) == {}
    assert run(spark, a, delete, a) == {one: "tilo"}
    assert run(spark, a, delete, update) == {one: "lara"}
    assert run(spark, a, delete, update, policy=ApplyPolicy(update="merge")) == {}
    assert run(spark, update, policy=ApplyPolicy(update="merge")) == {}
    assert run(spark, a, ("drop", "s", "books", None, None), a) == {one: "tilo"}
    assert run(spark, a, ("drop_database", "s", None, None, None), b) == {two: "x"}
    assert run(spark, a, update, policy=ApplyPolicy(update="ignore")) == {one: "tilo"}
