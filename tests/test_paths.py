"""Path and mapper semantics on small documents with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.functions import mappers as m
from foldex.functions.paths import PathError
from foldex.functions.mappers import TypeMismatch


def value(spark, ddl, doc, mapper, path):
    df = spark.createDataFrame([(doc,)], f"doc struct<{ddl}>")
    mapped = mapper.compile(F.col("doc"), df.schema["doc"].dataType, path)
    return df.select(mapped.value.alias("v")).first().v


def test_scalar_types(spark):
    ddl = "name:string,i:int,f:float,l:bigint,d:double,b:boolean,t:timestamp"
    at = dt.datetime(2023, 9, 1, 12, 30)
    doc = ("Hallo Leute", 45, 4.5, 45, 45.5, True, at)
    expected = {
        "name": (m.to_string, "Hallo Leute"), "i": (m.to_integer, 45), "f": (m.to_float, 4.5),
        "l": (m.to_long, 45), "d": (m.to_double, 45.5), "b": (m.to_boolean, True), "t": (m.to_date, at),
    }
    for path, (mapper, want) in expected.items():
        assert value(spark, ddl, doc, mapper, path) == want
    assert value(spark, ddl, doc, m.to_null, "name") is None
    assert value(spark, ddl, doc, m.to_string, "missing") is None


def test_mappers_do_not_convert(spark):
    with pytest.raises(TypeMismatch):
        value(spark, "i:int", (45,), m.to_string, "i")
    with pytest.raises(TypeMismatch):
        value(spark, "emb:struct<name:string>", (("x",),), m.to_string, "emb")


def test_embedded_scalar(spark):
    ddl = "name:string,emb:struct<name:string>"
    assert value(spark, ddl, ("x", ("Hallo ihr da draußen",)), m.to_string, "emb.name") == "Hallo ihr da draußen"
    assert value(spark, ddl, ("x", None), m.to_string, "emb.name") is None


def test_lists(spark):
    assert value(spark, "names:array<string>", (["eins", "zwei"],), m.to_string_list, "names") == ["eins", "zwei"]
    assert value(spark, "names:array<string>", (None,), m.to_string_list, "names") is None
    ddl = "emb:struct<names:array<string>>"
    assert value(spark, ddl, ((["eins", "zwei"],),), m.to_string_list, "emb.names") == ["eins", "zwei"]
    assert value(spark, ddl, (None,), m.to_string_list, "emb.names") == []


def test_list_through_documents(spark):
    ddl = "emb:struct<cities:array<struct<name:string>>>"
    doc = (([("bochum",), ("essen",), ("dortmund",)],),)
    assert value(spark, ddl, doc, m.to_string_list, "emb.cities.name") == ["bochum", "essen", "dortmund"]
    holes = (([("bochum",), (None,), None, ("essen",)],),)
    assert value(spark, ddl, holes, m.to_string_list, "emb.cities.name") == ["bochum", "essen"]
    assert value(spark, ddl, ((None,),), m.to_string_list, "emb.cities.name") == []


def test_scalar_leaf_is_wrapped(spark):
    ddl = "ort:struct<name:string>"
    assert value(spark, ddl, (("K",),), m.to_string_list, "ort.name") == ["K"]
    assert value(spark, ddl, ((None,),), m.to_string_list, "ort.name") == []


def test_deep_lists(spark):
    ddl = "o:array<struct<tags:array<string>,items:array<struct<k:int,more:array<struct<z:int>>>>>>"
    doc = ([
        (["a", "b"], [(1, [(10,), (11,)]), (2, None)]),
        (None, None),
        (["c"], [(3, []), None, (None, [(12,)])]),
        None,
    ],)
    assert value(spark, ddl, doc, m.to_string_list, "o.tags") == ["a", "b", "c"]
    assert value(spark, ddl, doc, m.to_integer_list, "o.items.k") == [1, 2, 3]
    assert value(spark, ddl, doc, m.to_integer_list, "o.items.more.z") == [10, 11, 12]
    assert value(spark, ddl, (None,), m.to_integer_list, "o.items.k") == []


def test_repeated_segment(spark):
    ddl = "a:struct<b:struct<a:struct<c:array<string>>>>"
    assert value(spark, ddl, (((([ "x"],),),),), m.to_string_list, "a.b.a.c") == ["x"]


@pytest.mark.parametrize("mapper,element,values", [
    (m.to_string_list, "string", ["a", "b"]),
    (m.to_date_list, "timestamp", [dt.datetime(2020, 1, 2)]),
    (m.to_boolean_list, "boolean", [True, False]),
    (m.to_integer_list, "int", [1, 2]),
    (m.to_long_list, "bigint", [1, 2]),
    (m.to_float_list, "float", [1.5]),
    (m.to_double_list, "double", [1.5, 2.5]),
])
def test_typed_lists(spark, mapper, element, values):
    assert value(spark, f"x:array<{element}>", (values,), mapper, "x") == values
    assert value(spark, f"e:array<struct<x:{element}>>", ([(v,) for v in values],), mapper, "e.x") == values


def test_bad_paths(spark):
    with pytest.raises(PathError):
        value(spark, "x:string", ("a",), m.to_string_list, "x")
    with pytest.raises(PathError):
        value(spark, "x:array<array<struct<y:int>>>", ([[(1,)]],), m.to_integer_list, "x.y")
    with pytest.raises(PathError):
        value(spark, "x:array<struct<y:string>>", ([("a",)],), m.to_string, "x.y")


def test_custom_mapper(spark):
    upper = m.custom(lambda path, doc: F.upper(doc.getField(path)), T.StringType())
    assert value(spark, "x:string", ("abc",), upper, "x") == "ABC"


def test_dates_render_in_utc_under_any_session_zone(spark):
    df = spark.sql("select timestamp'2023-09-01T23:30:00Z' as t")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = df.select(m.date_text(F.col("t"), T.TimestampType(), "yyyy-MM-dd HH:mm").alias("v")).first().v
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == "2023-09-01 23:30"
