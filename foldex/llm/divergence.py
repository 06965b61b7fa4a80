"""Source divergence audit: how far the words of a language's sources lie apart, from run-length columns.

A source's counts over the vocabulary of its language are a column. The vocabulary is ordered by the counts that a term
has in all sources, so terms with equal counts lie together; the order is cut into blocks, which Spark deals by range. In
a block each source's column is a list of runs of equal counts. For two sources the ends of their runs are merged, and
every piece between two ends adds its divergence times its length. Sums over blocks are exact integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldex.functions.sizing import fits_broadcast, salted_join
from foldex.llm.common import byte_table, slices, utf8, words_in, written

#: What terms are made of (letters and all beyond ASCII), and what a probability of 1 is counted as.
LETTERS = bytes(b for b in range(256) if chr(b).isascii() and chr(b).isalpha() or b > 127)
TERMS = byte_table(LETTERS)
SCALE = 1_000_000_000

#: Different counts to a block, and bytes of text worked on at once.
BLOCK = 20_000
TEXT = 8 << 20


# --- counts ----------------------------------------------------------------------------------------

def counted(groups: np.ndarray, texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of some texts, and per group and term: the group, the term's place, occurrences and texts."""
    words, doc = words_in([t.replace(b"\n", b" ") for t in texts], TERMS)
    coded = words.dictionary_encode()
    size = max(1, len(coded.dictionary))
    pairs, n = np.unique(doc.astype(np.int64) * size + coded.indices.to_numpy(), return_counts=True)
    keys, at = np.unique(groups[pairs // size] * size + pairs % size, return_inverse=True)
    return coded.dictionary, keys, np.bincount(at, n, len(keys)).astype(np.int64), np.bincount(at, minlength=len(keys))


def long_text(text: bytes) -> Iterator[bytes]:
    """A very long text in parts, cut where a term ends."""
    start = 0
    while start < len(text):
        end = start + TEXT
        while end < len(text) and text[end] in LETTERS:
            end += 1
        yield text[start:end]
        start = end


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per language, source and term, batch by batch."""
    for batch in slices(batches, "text", TEXT):
        if not batch.num_rows:
            continue
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        texts = utf8(batch.column("text"))
        if len(texts) == 1 and len(texts[0]) > TEXT:
            found: Counter = Counter()
            for part in long_text(texts[0]):
                terms, keys, n, _ = counted(np.zeros(1, np.int64), [part])
                found.update(dict(zip(terms.to_pylist(), n.tolist())) if len(keys) else {})
            names = pa.array(list(found), pa.binary())
            group, n, docs = np.zeros(len(found), np.int64), np.array(list(found.values()), np.int64), np.ones(len(found), np.int64)
            pairs, at = [(langs[0], sources[0])], np.arange(len(found))
        else:
            pairs = list(dict.fromkeys(zip(langs, sources)))
            place = {p: i for i, p in enumerate(pairs)}
            names, keys, n, docs = counted(np.array([place[p] for p in zip(langs, sources)], np.int64), texts)
            group, at = keys // max(1, len(names)), keys % max(1, len(names))
        yield pa.RecordBatch.from_arrays([
            pa.array([p[0] for p in pairs], pa.string()).take(pa.array(group)), pa.array([p[1] for p in pairs], pa.string()).take(pa.array(group)),
            names.take(pa.array(at)).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64()),
        ], ["lang", "source", "term", "n", "docs"])


def vocabulary(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, total, counts): the terms in enough documents of a language, with their count in each source that has them."""
    found = docs.mapInArrow(term_counts, "lang string, source string, term string, n long, docs long")
    # One shuffle, of rows that are summed already within a batch; both sums use it.
    by_source = found.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A term's counts are one entry per source at most.
    return by_source.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"), F.sum("docs").alias("docs"),
    ).where(F.col("docs") >= min_docs).drop("docs")


# --- runs --------------------------------------------------------------------------------------------

def shares(counts: np.ndarray, base: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / base), by long division in three steps of 1,000: exact below 9 * 10^15."""
    rest, out = counts + 1, np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1_000
        out = out * 1_000 + rest // base
        rest = rest % base
    return 1 + out


def columns_of(lengths: np.ndarray, at: np.ndarray, source: np.ndarray, n: np.ndarray, sources: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each source its runs over a block: where they end and their counts.

    ``lengths`` are the numbers of terms of the block's classes; class ``at`` has count ``n`` in ``source``, and 0 elsewhere.
    """
    ends = np.cumsum(lengths)
    order = np.lexsort((at, source))
    at, source, n = at[order], source[order], n[order]
    edges = np.searchsorted(source, np.arange(sources + 1))
    out = []
    for s in range(sources):
        own, count = at[edges[s]:edges[s + 1]], n[edges[s]:edges[s + 1]]
        # Runs of classes next to each other with equal counts; what lies between them is 0.
        new = np.append(True, (np.diff(own) > 1) | (np.diff(count) != 0))[:len(own)]
        first, last = own[new], own[np.append(new[1:], True)[:len(own)]] if len(own) else own
        start, stop = ends[first] - lengths[first], ends[last]
        bounds = np.empty(2 * len(first) + 1, np.int64)
        bounds[0:-1:2], bounds[1::2], bounds[-1] = start, stop, ends[-1]
        values = np.zeros(len(bounds), np.int64)
        values[1::2] = count[new]
        kept = np.diff(bounds, prepend=0) > 0
        out.append((bounds[kept], values[kept]))
    return out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def block_sums(classes: pa.Table, groups: pa.Table) -> pa.Table:
    """The divergence of every ordered pair of sources over one block of a language's vocabulary."""
    names, bases = groups.column("source").to_pylist(), groups.column("base").to_pylist()
    lang = groups.column("lang")[0].as_py() if groups.num_rows else None
    totals = np.zeros((len(names), len(names)), np.int64)
    if classes.num_rows and len(names) > 1:
        place = {name: i for i, name in enumerate(names)}
        classes = classes.sort_by("place")
        entries = classes.column("counts").to_pylist()
        at = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
        source = np.array([place[e["source"]] for row in entries for e in row], np.int64)
        n = np.array([e["n"] for row in entries for e in row], np.int64)
        runs = columns_of(classes.column("terms").to_numpy(), at, source, n, len(names))
        p_of = [shares(values, base) for (_, values), base in zip(runs, bases)]
        for a in range(len(names)):
            for b in range(a):
                cuts = np.union1d(runs[a][0], runs[b][0])
                length = np.diff(cuts, prepend=0)
                p, q = (p_of[i][np.searchsorted(runs[i][0], cuts)] for i in (a, b))
                totals[a, b], totals[b, a] = (divergence(p, q) * length).sum(), (divergence(q, p) * length).sum()
    a, b = np.nonzero(~np.eye(len(names), dtype=bool))
    texts = pa.array(names, pa.string())
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": texts.take(pa.array(a)), "item": texts.take(pa.array(b)),
                     "value": pa.array(totals[a, b], pa.int64())})


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of a language's sources."""
    # Terms with equal counts everywhere are one class: the order puts them, and what is like them, side by side.
    classes = kept.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("terms"))
    classes = written(classes, "divergence-classes")
    blocks = max(1, classes.count() // BLOCK)
    ordered = classes.repartitionByRange(blocks, "lang", "counts").sortWithinPartitions("lang", "counts")
    classes = written(ordered.withColumns({"block": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "divergence-blocks")
    # Block -1 has no terms: it gives a pair without any its 0.
    asked = classes.select("lang", F.col("block").alias("of")).distinct().unionByName(groups.select("lang", F.lit(-1).alias("of")).distinct())
    sides = groups.select("lang", "source", "base").join(asked, "lang")
    sums = classes.groupBy("lang", "block").cogroup(sides.groupBy("lang", "of")).applyInArrow(
        block_sums, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


# --- audit -------------------------------------------------------------------------------------------

def source_divergence(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """Parts of an audit: lang, source, part, item, value and rank.

    Terms are runs of letters and of anything beyond ASCII, A to Z lower-cased; a language keeps those in at least ``min_docs`` of its
    documents (V of them). A group, a source of a language or the whole language, gives a kept term with c occurrences in it
    p = 1 + floor(10^9 (c + 1) / (N + V)), N being all its occurrences of kept terms. The divergence of a term is
    floor((p - q)^2 / q). Part ``pair``: every other source of the language as q, summed over all kept terms; part ``term``: the group's own
    terms against the language as q, where p > q, the ``top`` largest. Ranks go by value and then by the item's bytes.

    Null text, language and source count as empty; repeated rows count each. Sources without any kept term have pairs but no terms; a
    language without kept terms has pairs of value 0, a single source no pairs; an empty table gives no rows.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    texts = docs.select(empty("text"), empty("lang"), empty("source"))
    kept = written(vocabulary(texts, min_docs), "divergence-terms")
    entries = kept.select("lang", "term", "total", F.inline("counts"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    own = entries.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    groups = texts.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs")).join(own, ["lang", "source"], "left").join(sizes, "lang", "left")
    v = F.coalesce("v", F.lit(0))
    groups = written(groups.select("lang", "source", (F.coalesce("own_n", F.lit(0)) + v).alias("base"),
                                   (F.coalesce("lang_n", F.lit(0)) + v).alias("lang_base")), "divergence-groups")

    pairs = pair_values(kept, groups).withColumn("part", F.lit("pair"))
    # One row per language and source: broadcast if that is little, else copied to salts, as a source may hold a third of all.
    sides = groups.select("lang", "source", "base", "lang_base")
    if fits_broadcast(sides):
        sided = entries.join(F.broadcast(sides), ["lang", "source"])
    else:
        sided = salted_join(entries, sides, ["lang", "source"], F.col("term"))
    share = f"1 + (cast({SCALE} as decimal(10,0)) * (cast(%s as decimal(19,0)) + 1)) div cast(%s as decimal(19,0))"
    valued = sided.withColumns({"p": F.expr(share % ("n", "base")), "q": F.expr(share % ("total", "lang_base"))}).where("p > q")
    terms = valued.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    every = pairs.withColumn("rank", F.row_number().over(best))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return every.select(columns).unionByName(ranked.select(columns))
