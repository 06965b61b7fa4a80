"""Extended JSON, the order of events, and reads that use what was written with the index."""

import json

import pytest
from pyspark.sql import functions as F

from foldex import FieldRule, IndexConfig, IndexStore
from foldex.functions import mappers as m
from foldex.functions.extended_json import plain_json
from foldex.plans.rebuild import backfill
from foldex.sources.changes import parse_events, stream_source


@pytest.mark.parametrize("text,plain", [
    ('{"a":{"$oid":"5f"},"b":{ "$numberLong" : "-12" }}', '{"a":"5f","b":-12}'),
    ('{"a":[{"$numberDouble":"1.5e-3"},{"$numberDouble":"NaN"},{"$numberInt":"7"}]}', '{"a":[1.5e-3,"NaN",7]}'),
    ('{"a":{"$date":"2020-01-02T03:04:05Z"}}', '{"a":"2020-01-02T03:04:05Z"}'),
    ('{"a":{"$date":{"$numberLong":"1577934245123"}},"b":[{"$date":-1}]}',
     '{"a":"2020-01-02T03:04:05.123Z","b":["1969-12-31T23:59:59.999Z"]}'),
    ('{"a":"{\\"$oid\\":\\"x\\"} stays"}', '{"a":"{\\"$oid\\":\\"x\\"} stays"}'),
    ('{"a":{"$oid":"quote \\" inside"}}', '{"a":"quote \\" inside"}'),
    ('{"a":1}', '{"a":1}'), ("{broken", "{broken"), (None, None),
])
def test_extended_json(spark, text, plain):
    df = spark.createDataFrame([(text,)], "t string").select(plain_json(F.col("t")).alias("t"))
    assert df.first().t == plain


def event(**more):
    return json.dumps({"operationType": "delete", "ns": {"db": "d", "coll": "c"}, "documentKey": {"_id": "x"}} | more)


def test_order_comes_from_the_source_the_event_or_the_cluster_time(spark):
    lines = spark.createDataFrame([(50, event(seq=1)), (51, event(clusterTime={"$timestamp": {"t": 2, "i": 3}}))],
                                  "offset bigint, value string")
    assert [r.seq for r in parse_events(lines, order="offset").collect()] == [50, 51]
    assert [r.seq for r in parse_events(lines).collect()] == [1, 2 * 2**32 + 3]


def test_any_streaming_source(spark, folder):
    path, name = folder("lines"), "any_source"
    spark.createDataFrame([(event(seq=1, operationType="remove"),)], "value string").write.text(path)
    stream = stream_source(spark, "text", {"path": path}, event_types={"remove": "delete"})
    query = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.seq, r.op, r.uid) for r in spark.table(name).collect()] == [(1, "delete", "x")]


def test_text_is_analysed_once(spark, folder):
    config = IndexConfig(rules={"c": [FieldRule("t", "t", m.to_string)]}, store_tokens=True)
    docs = spark.createDataFrame([("d", "c", str(i), (f"Some words, {i}",)) for i in range(20)],
                                 "database string, collection string, uid string, doc struct<t:string>")
    store = IndexStore(spark, folder("store"), config, docs.schema["doc"].dataType)
    backfill(docs)(store)
    view = store.view()
    hits = view.where(view.term("t", "7") & view.match("t", "WORDS")).documents
    assert [r._id for r in hits.collect()] == ["7"]
    assert "regexp" not in hits._jdf.queryExecution().executedPlan().toString()
