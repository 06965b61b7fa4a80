"""Near duplicates by BagMinHash: weighted-Jaccard signatures of bags of shingles, banded and verified.

A document is the bag of its runs of five words, each with its number of occurrences. Every shingle and
every occurrence up to its number owns a Poisson process of points, each with a time and a register; a register
keeps the earliest time, so two bags agree in a register with the probability of their weighted Jaccard
similarity, without bias. Occurrences are discretised hierarchically: (0, 1], (1, 2], (2, 4], (4, 8] and so
on have one process each, whose points also have a place in the interval and count up to the shingle's own
number. Points are made in order of time, only up to the time by which all registers are filled.

Documents with equal bags are one node. Nodes that share a band are compared with the band's smallest node first,
which joins most of a group of copies. What is left are pairs of a band in different components. Blocks of nodes
meet for them, first with their signatures alone: only nodes with a promising partner stay. They meet again with their
texts: the most similar pairs are verified first, and a pair that links have meanwhile joined is passed over. So no
pairs leave a task but links. With ``agree`` = 0 every pair that shares a band is promising; above it, pairs are left out
whose signatures agree in a smaller share of registers. Every link is verified on whole bags.

A row is known by a number that the first written table gives it, its text by two hashes of 64 bits each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldex.llm.common import row_key, utf8, written

WORDS = 5
THRESHOLD = 0.8
#: 21 bands of 6 registers: a pair of similarity 0.8 shares a band with probability 0.998.
BANDS, ROWS = 21, 6
REGISTERS = BANDS * ROWS
#: Pairs whose signatures agree in a smaller share of registers are not verified: of pairs of similarity 0.8 a share of 0.0004. With 0, all are verified.
AGREE = 0.68
#: Nodes of a band that meet another as many in one task.
BLOCK = 1000
U = np.uint64


# --- bags --------------------------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    """64-bit hashes of words, kept while a task has few of them."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 500_000:
            self[word] = value
        return value


def shingles(text: bytes | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the text's runs of ``words`` words, A to Z lower-cased, sorted; a shorter text is one run."""
    tokens = (text or b"").lower().split()
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    n = min(words, len(h))
    out = np.full(max(0, len(h) - n + 1) if n else 0, U(n))
    for i in range(n):
        out = mix(out * U(0x9E3779B97F4A7C15) + h[i:i + len(out)])
    out.sort()
    return out


def bag(text: bytes | None, words: int, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and how often each occurs."""
    s = shingles(text, words, hashes)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return s[first], np.diff(np.append(first, len(s)))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags; empty bags are equal."""
    total = int(a[1].sum() + b[1].sum())
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (total - both) if total else 1.0


# --- signatures --------------------------------------------------------------------------------

def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Earliest times by document and register. Documents of empty bags have none: infinity."""
    times = np.full((len(bags), REGISTERS), np.inf)
    todo = [d for d, b in enumerate(bags) if len(b[0])]
    #: Expected points by then, for a chance of 1 in 150 that a register is still empty.
    points = REGISTERS * (math.log(REGISTERS) + 5)
    while todo:
        doc = np.repeat(np.array(todo), [len(bags[d][0]) for d in todo])
        shingle = np.concatenate([bags[d][0] for d in todo])
        count = np.concatenate([bags[d][1] for d in todo])
        end = np.zeros(len(bags))
        end[todo] = [points / bags[d][1].sum() for d in todo]
        parts, low, level = [], 0, 0
        while len(shingle):
            width = max(1, low)
            parts.append((doc, mix(shingle + U(level * 0x632BE59BD9B4E019 % 2**64)), count, np.full(len(doc), low), np.full(len(doc), width)))
            low, level = low + width, level + 1
            more = count > low
            doc, shingle, count = doc[more], shingle[more], count[more]
        doc, seed, count, low, width = (np.concatenate(x) for x in zip(*parts))
        at, step, flat = np.zeros(len(doc)), 0, times.reshape(-1)
        while len(doc):
            step += 1
            h = mix(seed + U(step * 0x9E3779B97F4A7C15 % 2**64))
            at = at - np.log(((h >> U(11)).astype(np.float64) + 0.5) / 2.0**53) / width
            early = at <= end[doc]
            doc, seed, count, low, width, at = (x[early] for x in (doc, seed, count, low, width, at))
            g = mix(h[early] ^ U(0xD6E8FEB86659FD93))
            register = ((g >> U(32)) * U(REGISTERS) >> U(32)).astype(np.int64)
            place = low + 1 + ((g & U(0xFFFFFFFF)) * width.astype(np.uint64) >> U(32)).astype(np.int64)
            own = place <= count
            np.minimum.at(flat, doc[own] * REGISTERS + register[own], at[own])
        todo = [d for d in todo if np.isinf(times[d]).any()]
        points *= 2
    return times


def bands(times: np.ndarray) -> np.ndarray:
    """One hash per document and band."""
    bits = times.view(np.uint64).reshape(len(times), BANDS, ROWS)
    out = np.zeros((len(times), BANDS), np.uint64)
    for i in range(ROWS):
        out = mix(out * U(0x9E3779B97F4A7C15) + bits[:, :, i])
    return out.view(np.int64)


def short(times: np.ndarray) -> np.ndarray:
    """The registers in two bytes each, to estimate similarities."""
    return mix(times.view(np.uint64)).astype(np.uint16)


def agreement(a: pa.Array, b: pa.Array) -> np.ndarray:
    """The share of equal registers of pairs of signatures."""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(len(c), REGISTERS) for c in (a, b))
    return (x == y).mean(axis=1)


def promising(least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs whose signatures agree enough."""
        for batch in batches:
            yield batch.select(["a", "b"]).filter(pa.array(agreement(batch.column("signature_a"), batch.column("signature_b")) >= least))
    return run


def apart(table: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The promising pairs of two blocks of a band (``side`` 1 and 2, or 0: both), as places in ``table``, and how far they agree.

    Pairs of different components for which this is the first band they share.
    """
    side, node = table.column("side").to_numpy(), table.column("node").to_numpy()
    component, here = table.column("component").to_numpy(), table.column("band")[0].as_py()
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    band = np.stack(table.column("bands").to_pylist())
    left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
    found = []
    for i in left:
        other = right[(component[right] != component[i]) & ((side[i] != 0) | (node[right] > node[i]))]
        share = (signature[other] == signature[i]).mean(axis=1)
        keep = share >= least
        if here:
            keep[keep] = ~(band[other[keep], :here] == band[i, :here]).any(axis=1)
        found.append((np.full(keep.sum(), i), other[keep], share[keep]))
    a, b, share = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    return a, b, share


def partnered(least: float) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """The nodes with a promising partner in these blocks."""
        a, b, _ = apart(table, least)
        return table.select(["band", "hash", "i", "j", "node", "component", "side"]).take(pa.array(np.union1d(a, b).astype(np.int64)))
    return run


def joined(words: int, threshold: float, least: float) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Links between components: the most similar promising pairs first, while their components are apart."""
        component, node = table.column("component").to_numpy(), table.column("node").to_numpy()
        a, b, share = apart(table, least)
        hashes, bags, texts = WordHashes(), {}, {i: table.column("text")[int(i)] for i in {*a.tolist(), *b.tolist()}}
        parent = {c: c for c in component.tolist()}

        def top(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        def bag_of(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in bags:
                bags[i] = bag((texts[i].as_py() or "").encode(), words, hashes)
            return bags[i]

        links = []
        for k in np.argsort(-share, kind="stable").tolist():
            i, j = int(a[k]), int(b[k])
            x, y = top(int(component[i])), top(int(component[j]))
            if x != y and similarity(bag_of(i), bag_of(j)) >= threshold:
                parent[x] = y
                links.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})
    return run


def signed(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document a 128-bit hash of its bag and its bands (none for an empty bag)."""
        hashes = WordHashes()
        for whole in batches:
            start, held, size = 0, [], 0
            texts = utf8(whole.column("text"))
            for i, text in enumerate(texts):
                held.append(bag(text, words, hashes))
                size += len(held[-1][0])
                if size > 200_000 or i == len(texts) - 1:
                    batch = whole.slice(start, len(held))
                    times = signatures(held)
                    found = bands(times)
                    names = [xxhash.xxh3_128_digest(b[0].tobytes() + b[1].tobytes()) for b in held]
                    halves = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("row"), batch.column("check"), batch.column("doc_id"), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                        pa.array([f if len(b[0]) else [] for f, b in zip(found, held)], pa.list_(pa.int64())),
                        pa.array([x.tobytes() for x in short(times)], pa.binary()),
                    ], ["row", "check", "doc_id", "bag1", "bag2", "bands", "signature"])
                    start, held, size = i + 1, [], 0
    return run


def verified(words: int, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs that are similar enough."""
        hashes = WordHashes()
        last: tuple[int | None, tuple] = (None, ())
        for batch in batches:
            a, b = batch.column("a").to_pylist(), utf8(batch.column("text_a"))
            near = []
            for name, left, right in zip(a, b, utf8(batch.column("text_b"))):
                if name != last[0]:
                    last = (name, bag(left, words, hashes))
                near.append(similarity(last[1], bag(right, words, hashes)) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))
    return run


# --- graph -------------------------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(node, component): each linked node's component, named by its smallest node.

    Labels spread along the links and from label to label, so chains need few rounds.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(links.select(F.col("b"), F.col("a")))
    labels = written(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy("node").agg(
            F.min("component").alias("near"))
        beyond = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        smallest = F.least("component", "near", "beyond")
        new = written(labels.join(around, "node").join(beyond, "component").select(
            "node", smallest.alias("component"), (smallest != F.col("component")).alias("new")), "labels")
        labels = new.drop("new")
        if new.where("new").isEmpty():
            return labels


# --- operator ----------------------------------------------------------------------------------

def text_key() -> list[Column]:
    """Two independent hashes of a document's id and text, ``row`` and ``check``."""
    return [row_key("doc_id", "text").alias("row"), F.xxhash64(F.lit("check"), "doc_id", "text").alias("check")]


def near_links(docs: DataFrame, nodes: DataFrame, words: int, threshold: float, agree: float) -> DataFrame:
    """(node, component) of the nodes that have a verified link; ``nodes``: node, row, check, bands, signature."""
    banded = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    shared = banded.groupBy("band", "hash").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = written(shared.where("n > 1"), "buckets")
    members = written(banded.join(shared, ["band", "hash"]), "members")
    # Always by sorting: a broadcast that fits small inputs only would make them look cheaper than they are.
    some = nodes.join(members.select("node").distinct().hint("merge"), "node", "left_semi")
    texts = docs.select(*text_key(), "text").join(some.hint("merge"), ["row", "check"]).drop("row", "check")
    texts = written(texts.dropDuplicates(["node"]), "texts")

    stars = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    for end in "ab":
        side = {"node": end, "signature": f"signature_{end}"}
        stars = stars.join(texts.select(*[F.col(k).alias(v) for k, v in side.items()]), end)
    stars = stars.mapInArrow(promising(agree), "a long, b long")
    for end in "ab":
        stars = stars.join(texts.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}")), end)
    links = written(stars.mapInArrow(verified(words, threshold), "a long, b long"), "stars")

    found = components(links)
    held = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = held.groupBy("band", "hash").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    held = held.join(written(split.select("band", "hash"), "split"), ["band", "hash"])
    # Every two blocks of a band meet once; a node's signature is sent along once for each block.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = held.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "band", "hash", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "component",
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"))
    met = ["band", "hash", "i", "j"]
    some = written(dealt.join(texts.drop("text"), "node").groupBy(*met).applyInArrow(partnered(agree), dealt.schema), "partnered")
    more = written(some.join(texts, "node").groupBy(*met).applyInArrow(joined(words, threshold, agree), "a long, b long"), "across")
    return found if more.isEmpty() else components(links.unionByName(more))


def classified(docs: DataFrame, words: int, threshold: float, agree: float) -> DataFrame:
    """Per document: row, check, doc_id, class_id, class_size and kept."""
    narrow = docs.select(*text_key(), F.col("doc_id").cast("bigint"), "text")
    kinds = "row long, check long, doc_id long, bag1 long, bag2 long, bands array<long>, signature binary"
    base = written(narrow.mapInArrow(signed(words), kinds).withColumn("node", F.monotonically_increasing_id()), "bags")
    same = written(base.groupBy("bag1", "bag2").agg(F.min("node").alias("first")), "same")
    nodes = base.join(same.select(F.col("first").alias("node")), "node", "left_semi")
    found = near_links(docs, nodes.select("node", "row", "check", "bands", "signature"), words, threshold, agree)

    named = same.join(found.select(F.col("node").alias("first"), "component"), "first", "left").select(
        "bag1", "bag2", F.coalesce("component", "first").alias("component"))
    rows = base.select("row", "check", "doc_id", "node", "bag1", "bag2").join(written(named, "named"), ["bag1", "bag2"])
    rows = written(rows.select("row", "check", "doc_id", "node", "component"), "classes")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    classes = written(rows.groupBy("component").agg(best.alias("best"), F.count(F.lit(1)).alias("class_size")), "class-heads")
    return rows.join(classes, "component").select(
        "row", "check", "doc_id", F.col("best.doc_id").alias("class_id"), "class_size", (F.col("node") == F.col("best.node")).alias("kept"))


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, agree: float = AGREE) -> DataFrame:
    """Per document: row (its row key), doc_id, class_id, class_size and kept.

    Documents linked by similarity of at least ``threshold``, directly or over others, form a class, named by its
    smallest doc_id (null last), whose document is kept; of repeated rows one is kept. Texts without words
    (null, empty) are equal. Texts of fewer words than a shingle are one shingle. An empty table gives no rows.
    Pairs whose signatures agree in a smaller share than ``agree`` are not verified; with 0, all pairs of a band are.
    """
    return classified(docs, words, threshold, agree).drop("check")


def without_near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, agree: float = AGREE) -> DataFrame:
    """The documents, one of each class of ``near_duplicates``, with all their columns.

    The document of the smallest doc_id stays (null last). Of rows with equal id and text one stays. One of the
    documents without words stays, null or empty. An empty table stays empty.
    """
    kept = classified(docs, words, threshold, agree).where("kept").select("row", "check")
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(doc, *text_key())
    return rows.join(kept, ["row", "check"], "left_semi").dropDuplicates(["row", "check"]).select("doc.*")
