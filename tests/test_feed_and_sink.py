"""The rolling event source and the action sink: positions, splits, restarts, and batches that are sent once."""

import json
import os

import pytest

from foldex import ApplyPolicy, FieldRule, IndexConfig, IndexService, IndexStore
from foldex.functions import mappers as m
from foldex.operators import sink
from foldex.operators.sink import ActionStreamWriter, ActionWriter, export_changes, sent_actions, sent_batches
from foldex.sources import feed
from foldex.sources.feed import FeedReader, feed_stream
from pyspark.sql import Row
from pyspark.sql import types as T


def write(path, name, lines, end="\n"):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "a") as file:
        file.write("\n".join(lines) + end)


def read(reader, start, end):
    out = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            out += zip(batch.column("file").to_pylist(), batch.column("at").to_pylist(), batch.column("value").to_pylist())
    return [value for *_, value in sorted(out)]


LINES = [f'{{"n": {i}, "text": "{"é" * (i * 37 % 101)}"}}' for i in range(200)]


@pytest.mark.parametrize("split", [1, 7, 100, 5_000, 1 << 20])
def test_every_line_is_read_once(folder, split, monkeypatch):
    monkeypatch.setattr(feed, "BLOCK", 64)
    path = folder("events")
    write(path, "a.json", LINES[:80])
    write(path, "b.json", LINES[80:81], end="")  # complete, without a line end
    write(path, "c.json", ["", *LINES[81:], ""])
    write(path, "_SUCCESS", [])
    reader = FeedReader(path, None, None, split)
    assert read(reader, reader.initialOffset(), reader.latestOffset()) == LINES


def test_lines_under_way_wait(folder):
    path = folder("events")
    reader = FeedReader(path, None, None, 50)
    assert reader.latestOffset() == reader.initialOffset() and read(reader, reader.initialOffset(), reader.latestOffset()) == []
    write(path, "a.json", LINES[:3])
    write(path, "a.json", [LINES[3][:9]], end="")
    first = reader.latestOffset()
    assert read(reader, reader.initialOffset(), first) == LINES[:3]
    write(path, "a.json", [LINES[3][9:], LINES[4]])
    second = reader.latestOffset()
    assert read(reader, first, second) == LINES[3:5]
    write(path, "b.json", LINES[5:9])
    assert read(reader, second, reader.latestOffset()) == LINES[5:9]


@pytest.mark.parametrize("limit", [1, 150, 4_000, 10**9])
def test_bounded_batches_go_on_after_a_restart(folder, limit):
    path, positions = folder("events"), folder("positions")
    write(path, "a.json", LINES[:120])
    write(path, "b.json", LINES[120:])
    got, start, batches = [], {"file": "", "at": 0}, 0
    while True:
        reader = FeedReader(path, limit, positions, 1_000)  # a new process each time
        end = reader.latestOffset()
        if end == start:
            # The source was told of the batch before only: it catches up in the next trigger.
            end = reader.latestOffset()
            if end == start:
                break
        part = read(reader, start, end)
        assert sum(len(x.encode()) for x in part[:-1]) <= limit
        got += part
        if batches:
            reader.commit(start)  # Spark tells of a batch when it plans the next one
        start, batches = end, batches + 1
    assert got == LINES and (batches > 1) == (limit < 10**9)
    with pytest.raises(ValueError):
        FeedReader(path, 5, None, 10)


def event(seq, kind, uid, **doc):
    return json.dumps({"seq": seq, "operationType": kind, "ns": {"db": "db", "coll": "c"}, "documentKey": {"_id": uid}, "fullDocument": doc or None})


def test_a_stream_resumes_in_the_middle_of_a_file(spark, folder):
    path = folder("events")
    config = IndexConfig(rules={"c": (FieldRule("v.n", "n", m.to_long),)})
    store = IndexStore(spark, folder("store"), config, T.StringType(), ApplyPolicy())
    write(path, "000.json", [event(1, "insert", "a", v={"n": 1}), event(2, "insert", "b", v={"n": 2})])
    write(path, "000.json", ['{"seq": 3, "operationT'], end="")
    service = IndexService(store, lambda: feed_stream(spark, path))
    service.drain()
    values = lambda: {r._id: r.n for r in store.view().documents.collect()}
    assert values() == {"a": 1, "b": 2}
    with open(f"{path}/000.json", "a") as file:
        file.write('ype": "delete", "ns": {"db": "db", "coll": "c"}, "documentKey": {"_id": "a"}}\n')
    write(path, "001.json", [event(4, "update", "b", v={"n": 5}), event(5, "insert", "d", v={"n": 6})])
    IndexService(store, lambda: feed_stream(spark, path)).drain()
    assert values() == {"b": 5, "d": 6} and store.log().count() == 5


# --- sink ------------------------------------------------------------------------------------------


def action(uid):
    return Row(index_name="i", database="d", collection="c", uid=uid, action="delete", body=None)


def test_only_published_files_are_sent(spark, folder):
    path = folder("actions")
    writer = ActionWriter(path, 7)
    lost = writer.write(iter([action("twice")]))  # a task that was run again
    done = [writer.write(iter([action("twice"), action("é")])), writer.write(iter([])), None]
    assert sent_actions(spark, path).count() == 0
    writer.commit(done)
    assert [r.uid for r in sent_actions(spark, path).orderBy("uid").collect()] == ["twice", "é"]
    late = ActionWriter(path, 7)
    late.commit([late.write(iter([action("again")]))])  # the same batch, after a failure
    broken = ActionStreamWriter(path)
    broken.abort([broken.write(iter([action("aborted")])), None], 8)
    broken.commit([broken.write(iter([action("next")]))], 8)
    assert {(r.uid, r.number) for r in sent_actions(spark, path).collect()} == {("twice", 7), ("é", 7), ("next", 8)}
    assert {r.uid for r in sent_actions(spark, path, after=7).collect()} == {"next"}
    assert [b["number"] for b in sent_batches(path)] == [7, 8] and lost.name in os.listdir(f"{path}/rows")


def test_exports_follow_the_versions_of_a_store(spark, folder):
    config = IndexConfig(rules={"c": (FieldRule("n", "n", m.to_long),)})
    store = IndexStore(spark, folder("store"), config, T.StringType(), ApplyPolicy())
    target = folder("actions")
    columns = "seq bigint, op string, database string, collection string, uid string, doc string"
    assert export_changes(store, target) == 0 and sent_batches(target) == []
    store.append(spark.createDataFrame([(1, "insert", "d", "c", "a", '{"n": 1}'), (2, "insert", "d", "c", "b", '{"n": 2}')], columns))
    store.compact()
    store.append(spark.createDataFrame([(3, "delete", "d", "c", "a", None), (4, "update", "d", "c", "b", '{"n": 3}')], columns))
    assert export_changes(store, target) == 1
    store.compact()
    assert export_changes(store, target) == 2 == export_changes(store, target)
    got = [(r.number, r.uid, r.action, r.body and json.loads(r.body).get("n")) for r in sent_actions(spark, target).collect()]
    assert sorted(got) == [(1, "a", "index", 1), (1, "b", "index", 2), (2, "a", "delete", None), (2, "b", "update", 3)]


def test_streams_write_each_batch_once(spark, folder):
    spark.dataSource.register(sink.ActionBatches)
    source, target = folder("rows"), folder("actions")
    rows = spark.createDataFrame([action(f"u{i}") for i in range(5)], sink.ACTIONS)
    for _ in range(2):
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source).writeStream.format(sink.FORMAT)
        stream.option("path", target).option("checkpointLocation", f"{target}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert sent_actions(spark, target).count() == 10 and [b["number"] for b in sent_batches(target)] == [0, 1]
