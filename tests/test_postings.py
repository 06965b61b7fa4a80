"""The stored inverted index against views of the store: after every kind of change, and without reading texts."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldex import ApplyPolicy, FieldRule, IndexConfig, IndexStore
from foldex.functions import mappers as m
from foldex.functions.analysis import Analyzer
from foldex.functions.blocks import block_pieces
from foldex.plans import postings as postings_module
from foldex.plans.postings import InvertedIndex

RULES = (FieldRule("text", "text", m.to_string), FieldRule("tags", "tags", m.to_string_list, keyword=True), FieldRule("n", "n", m.to_long))
CONFIG = IndexConfig(rules={"c0": RULES, "c1": RULES}, facets=("tags", "_collection")).with_analyzer("c1", Analyzer(lower=False))
DOC = "struct<text: string, tags: array<string>, n: bigint>"
WORDS = ["Red", "fox", "the", "a", "über", "x1", "Fox", "red"]


def new_store(spark, folder, **policy):
    doc_type = spark.createDataFrame([], f"doc {DOC}").schema["doc"].dataType
    return IndexStore(spark, folder("store"), CONFIG, doc_type, ApplyPolicy(**policy))


def frame(spark, rows):
    return spark.createDataFrame(rows, f"seq bigint, op string, database string, collection string, uid string, doc {DOC}")


def feed(rng, start, n):
    """Random changes, drops among them."""
    rows = []
    for seq in range(start, start + n):
        op = rng.choice(["insert"] * 5 + ["update"] * 3 + ["delete"] * 2 + ["drop"] * (rng.random() < 0.1))
        doc = {"text": " ".join(rng.choices(WORDS, k=rng.randint(0, 6))) if rng.random() < 0.9 else None,
               "tags": rng.choices(["t1", "t2", "t3"], k=rng.randint(0, 3)), "n": seq}
        rows.append((seq, op, rng.choice(["db0", "db1"]), rng.choice(["c0", "c1"]), None if op == "drop" else f"u{rng.randint(0, 25)}",
                     doc if op in ("insert", "update") else None))
    return rows


def keys(df):
    return sorted((r._database, r._collection, r._id) for r in df.collect())


def check(index, view):
    """Every read of the index gives what the view of the store gives."""
    for word in ("red", "Red", "x1", "missing"):
        assert keys(index.term("text", word)) == keys(view.where(view.term("text", word)).documents)
    assert keys(index.match("text", "FOX the")) == keys(view.where(view.match("text", "FOX the")).documents)
    assert keys(index.match("text", " -- ")) == []
    assert keys(index.term("tags", "t2")) == keys(view.where(F.array_contains("tags", "t2")).documents)
    columns = ("term", "_database", "_collection", "_id", "tf")
    of = lambda df: Counter(tuple(r[c] for c in columns) for r in df.collect())
    assert of(index.postings("text")) == of(view.postings("text"))
    counts = lambda df: {(r.dim, r.value): r.n for r in df.collect()}
    assert counts(index.facets()) == counts(view.facets())
    some = view.term("text", "the") & F.array_contains("tags", "t1")
    assert counts(index.facets({"text": "the", "tags": "t1"})) == counts(view.facets(some))


def test_index_follows_its_store(spark, folder):
    rng = random.Random(3)
    store = new_store(spark, folder)
    index = InvertedIndex(store, buckets=3, max_segments=3)
    assert index.refresh().version == 0 and keys(index.term("text", "red")) == []
    segments = []
    for step in range(4):
        store.append(frame(spark, feed(rng, 1 + step * 60, 60)))
        store.compact()
        if step == 2:
            store.drop_index("c1")
        segments.append(len(index.refresh().segments))
        if step in (1, 3):
            check(index, store.version(store.head().version))
    assert segments == [1, 2, 3, 1]
    assert index.refresh() == index.head()
    index.vacuum()
    check(index, store.version(store.head().version))


def test_fresh_where_the_store_has_forgotten(spark, folder):
    store = new_store(spark, folder)
    index = InvertedIndex(store)
    for seq in (1, 2, 3):
        store.append(frame(spark, [(seq, "insert", "db0", "c0", f"u{seq}", {"text": "red", "tags": [], "n": 1})]))
        store.compact()
        if seq == 1:
            index.refresh()
    store.vacuum(keep=1)
    assert len(index.refresh().segments) == 1 and len(keys(index.term("text", "red"))) == 3


def test_blocks_cover_ranges_of_numbers(spark, folder, monkeypatch):
    """A term that all documents have is many blocks, none larger than its range of numbers."""
    monkeypatch.setattr(postings_module, "BLOCK_BITS", 4)
    store = new_store(spark, folder)
    rows = [(i, "insert", "db0", "c0", f"u{i:03d}", {"text": "the " * (i % 3 + 1), "tags": ["t1"], "n": i}) for i in range(1, 201)]
    store.append(frame(spark, rows))
    store.compact()
    index = InvertedIndex(store)
    index.refresh()
    blocks = index.blocks().where("term = 'the'").collect()
    assert len(blocks) >= 13 and sum(b.n for b in blocks) == 200 and all(b.n == len(b.offsets) <= 16 and max(b.offsets) < 16 for b in blocks)
    assert Counter(r.tf for r in index.postings("text").collect()) == Counter(i % 3 + 1 for i in range(1, 201))


@pytest.fixture
def built(spark, folder):
    store = new_store(spark, folder)
    store.append(frame(spark, feed(random.Random(5), 1, 40)))
    store.compact()
    index = InvertedIndex(store)
    index.refresh()
    return index


def plan(df):
    return df._jdf.queryExecution().toString()


def test_queries_read_no_texts(built):
    for df in (built.term("text", "red"), built.match("text", "red fox"), built.facets({"text": "red"})):
        text = plan(df)
        schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
        assert schemas and all("text" not in s and "tokens" not in s and "tags" not in s for s in schemas)
        assert "IsNotNull(term)" in text or "In(term" in text
    # Folders of other fields and buckets are not opened.
    assert re.search(r"PartitionFilters: \[[^\]]*field[^\]]*bucket", plan(built.term("text", "red")))


def test_facet_counts_add_up_blocks(built):
    text = plan(built.facets())
    assert "Generate" not in text and "offsets" not in "".join(re.findall(r"ReadSchema: (.*)", text))


def test_pieces_of_any_batches():
    """Whatever a task holds at a time, every token is in one piece; many nulls, several indices, frequencies beyond 16 bits."""
    rng, rows = random.Random(7), []
    for i in range(300):
        words = rng.choices(["a", "b", "ü", "x1", None], k=rng.randint(0, 5)) if rng.random() < 0.8 else None
        rows.append({"doc_no": i * 7 + (1 << 33) * (i % 2), "index_name": rng.choice(["i", "j"]), "tokens_0": words, "tokens_1": ["a"] if i % 3 else None})
    rows[5]["tokens_0"] = ["a"] * 40_000 + ["b"]
    rng.shuffle(rows)
    kinds = pa.schema([("doc_no", pa.int64()), ("index_name", pa.string()), ("tokens_0", pa.list_(pa.string())), ("tokens_1", pa.list_(pa.string()))])
    whole = pa.RecordBatch.from_pylist(rows, kinds)
    want = Counter((f, r["index_name"], t, r["doc_no"]) for r in rows for f, k in (("f", "tokens_0"), ("g", "tokens_1")) for t in r[k] or () if t is not None)
    for size, tokens in ((300, 1 << 21), (40, 100), (300, 1), (1, 50)):
        batches = [whole.slice(k, size) for k in range(0, 300, size)]
        got = Counter()
        for piece in block_pieces(["f", "g"], 4, tokens)(iter([*batches, whole.slice(0, 0)])):
            for p in piece.to_pylist():
                tfs = p["large"] or p["tfs"]
                assert (p["large"] is None) != (p["tfs"] is None) and len(tfs) == len(p["offsets"]) and p["offsets"] == sorted(set(p["offsets"]))
                for o, tf in zip(p["offsets"], tfs):
                    key = (p["field"], p["index_name"], p["term"], p["block"] * 16 + o)
                    assert 0 <= o < 16 and key not in got
                    got[key] = tf
        assert got == want
    assert not list(block_pieces(["f", "g"], 16)(iter([whole.slice(0, 0)])))


def test_offsets_of_all_16_bits(spark, folder):
    """Numbers above 32,767 in their block, which travel as signed ones, come back as they were."""
    batch = pa.RecordBatch.from_pylist([{"doc_no": n, "index_name": "i", "tokens_0": ["a"]} for n in (0, 32_767, 32_768, 65_535)])
    (piece,) = block_pieces(["f"], 16)(iter([batch]))
    assert [o & 0xFFFF for o in piece.column("offsets").to_pylist()[0]] == [0, 32_767, 32_768, 65_535]


def joined(df):
    """The joins of a plan that has not run yet, each with the columns of its sides."""
    found = []

    def walk(node):
        kids = [node.children().apply(k) for k in range(node.children().size())]
        if "Join" in node.nodeName():
            found.append((node.nodeName(), [{k.output().apply(i).name() for i in range(k.output().size())} for k in kids]))
        for kid in kids:
            walk(kid)

    walk(df._jdf.queryExecution().sparkPlan())
    return found


def test_comparing_versions_moves_digests(spark, folder):
    """Documents meet as keys and digests, with drops too; what they say differs is what bodies say."""
    store = new_store(spark, folder)
    rng = random.Random(11)
    store.append(frame(spark, feed(rng, 1, 40)))
    store.compact()
    store.append(frame(spark, feed(rng, 41, 30) + [(90, "drop", "db0", "c1", None, None)]))
    store.compact()
    of = lambda df: sorted((r.index_name, r.database, r.collection, r.uid, r.action) for r in df.collect())
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = store.changes(1, 2, ["text", "tags"], digests=True)
        joins = joined(found)
        assert len(joins) >= 3 and not any({"text", "tags"} & s for _, sides in joins for s in sides)
        assert of(found) == of(store.changes(1, 2, ["text", "tags"])) != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_dead_numbers_leave_the_keys(spark, folder):
    """Postings are neither sorted nor met with the dead: only documents are."""
    store = new_store(spark, folder)
    index = InvertedIndex(store)
    for seq, text in ((1, "red"), (2, "fox")):
        store.append(frame(spark, [(seq, "insert", "db0", "c0", "u1", {"text": text, "tags": [], "n": seq})]))
        store.compact()
        index.refresh()
    found = index.postings("text")
    assert [(r.term, r._id, r.tf) for r in found.collect()] == [("fox", "u1", 1)]
    joins = joined(found)
    assert sorted(name for name, _ in joins) == ["BroadcastHashJoin", "ShuffledHashJoin"]
    assert all("term" not in side for name, sides in joins if name == "BroadcastHashJoin" for side in sides)


def test_texts_of_unchanged_documents_stay(spark, folder):
    """Where the index follows its store, documents meet broadcast hashes of the changed keys before their texts move."""
    store = new_store(spark, folder)
    index = InvertedIndex(store)
    for seq in (1, 2):
        store.append(frame(spark, [(seq, "insert", "db0", "c0", f"u{seq}", {"text": "red", "tags": [], "n": seq})]))
        store.compact()
        head = index.refresh() if seq == 1 else index.head()
    found = index._changed(head, 2, "next", folder("draft"))
    hashed = [sides for name, sides in joined(found) if name == "BroadcastHashJoin" and sides[1] == {"_hash"}]
    assert len(hashed) == 1 and "text" in hashed[0][0]
    assert [(r._id, r.text) for r in found.collect()] == [("u2", "red")]
