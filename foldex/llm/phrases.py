"""Phrase collocation mining: tries of words count phrases, spilled as sorted runs.

Every task counts the phrases of its texts in a trie over word ids. The root holds one container per first word, a hash
table of what follows; a container that grows too large bursts into one container per second word. When a trie holds
too many phrases, its largest subtrees are taken out whole and leave the task as runs in the order of their
words: one row per subtree. Runs are dealt by language and first word and merged there, subtree by subtree; the subtrees of
frequent first words are split by the second word, into so many parts that no part is large.

Counting goes word by word, pair by pair, and then the longer phrases, because a phrase is never more frequent
than a part of it: phrases with a rare word, and longer ones with a rare pair, are not counted at all. Which parts are
frequent is told to tasks by a bit per hash, in an array of fixed size: where hashes meet, a rare part
passes and costs time, and exact sums decide in the end. So all counts are exact and nothing grows with the vocabulary.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldex.llm.common import byte_table, slices, utf8, words_in, written

#: What ends a piece of text, and what ends a word in it.
ENDS = b".,;:!?\n\x0b\x0c\r"
WORDS = byte_table(bytes(b for b in range(256) if b not in b" \t" + ENDS), ENDS)
PIECE_END = re.compile(rb"[.,;:!?\n-\r]")

#: Bits of the array that tells frequent parts: 8 MiB, whatever the corpus.
SLOTS = 1 << 26
#: Phrases a task's trie holds, entries of a container before it bursts, word ids, and bytes of a language's text, or of runs, worked
#: on at once (the rows of a slice hold up to four times as many, of all languages).
ENTRIES = 400_000
BURST = 16_384
IDS = 1 << 21
TEXT = 4 << 20
#: Occurrences of a first word beyond which its subtree is split, and places of the table that tells into how many parts: words
#: whose hashes meet there are split alike.
WHOLE = 1 << 17
LEVELS = 1 << 16
#: Copies of the counts of single words in joins: cuts of phrases that begin alike are dealt to them.
SALTS = 16


def slot(lang: bytes, word: bytes) -> int:
    """A hash of a word, of 63 bits: the lowest tell its slot."""
    return xxhash.xxh3_64_intdigest(lang + b"\n" + word) & (2**63 - 1)


def pair_slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hashes of pairs, from those of their words alone: a pair's text is not needed."""
    mixed = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ right.astype(np.uint64)
    for odd, shift in ((0xBF58476D1CE4E5B9, 29), (0x94D049BB133111EB, 32)):
        mixed = (mixed ^ mixed >> np.uint64(shift)) * np.uint64(odd)
    return ((mixed ^ mixed >> np.uint64(31)) & np.uint64(2**63 - 1)).astype(np.int64)


def grown(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with room for ``size`` numbers at least."""
    return values if size <= len(values) else np.append(values, np.zeros(max(size - len(values), len(values)), values.dtype))


class Trie:
    """Counts of phrases of two to four words: the first word's container, or one container per second word.

    A phrase is its first word's id and a number that holds the ids of the others, 21 bits each, from the second on.
    """

    def __init__(self):
        self.containers: dict[int, dict] = {}
        self.burst: dict[int, dict[int, dict]] = {}
        self.entries = 0

    def add(self, first: np.ndarray, rest: np.ndarray, n: np.ndarray) -> None:
        """Adds distinct phrases in order, with their counts."""
        edges = np.flatnonzero(np.diff(first, prepend=-1, append=-1))
        words, edges = first[edges[:-1]].tolist(), edges.tolist()
        rest, n = rest.tolist(), n.tolist()
        for word, start, end in zip(words, edges, edges[1:]):
            container = self.containers.get(word)
            if container is not None:
                self.entries -= len(container)
                for key, count in zip(rest[start:end], n[start:end]):
                    container[key] = container.get(key, 0) + count
            elif word in self.burst:
                children = self.burst[word]
                for key, count in zip(rest[start:end], n[start:end]):
                    container = children.setdefault(key >> 42, {})
                    self.entries += key not in container
                    container[key] = container.get(key, 0) + count
                continue
            else:
                container = self.containers[word] = dict(zip(rest[start:end], n[start:end]))
            self.entries += len(container)
            if len(container) > BURST:
                children = self.burst[word] = {}
                for key, count in self.containers.pop(word).items():
                    children.setdefault(key >> 42, {})[key] = count

    def taken(self, left: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Takes out whole subtrees, the largest first, until at most ``left`` phrases stay: first words, how many phrases
        begin with each, and the rests and counts of all."""
        sizes = {word: len(container) for word, container in self.containers.items()}
        sizes |= {word: sum(map(len, children.values())) for word, children in self.burst.items()}
        words, parts = [], []
        for word in sorted(sizes, key=sizes.get, reverse=True):
            if self.entries <= left:
                break
            words.append(word)
            parts += [self.containers.pop(word)] if word in self.containers else self.burst.pop(word).values()
            self.entries -= sizes[word]
        many = np.fromiter(map(sizes.get, words), np.int64, len(words))
        return (np.array(words, np.int64), many, np.fromiter(chain.from_iterable(parts), np.int64, many.sum()),
                np.fromiter(chain.from_iterable(p.values() for p in parts), np.int64, many.sum()))

    def take(self, left: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """What ``taken`` takes out, subtree by subtree: first word, rests and counts."""
        words, many, rest, n = self.taken(left)
        for word, end, size in zip(words.tolist(), np.cumsum(many).tolist(), many.tolist()):
            yield word, rest[end - size:end], n[end - size:end]


def counted(ids: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct phrases of ``n`` words that begin at ``at``, in order: first words, rests and counts."""
    key = ids[at]
    for k in range(1, min(n, 3)):
        key = key << 21 | ids[at + k]
    if n < 4:
        key.sort()
        edges = np.flatnonzero(np.diff(key, prepend=-1))
        many, key = np.diff(edges, append=len(key)), key[edges]
        return key >> 21 * (n - 1), key << 21 * (4 - n) & (2**63 - 1), many
    last = ids[at + 3]
    order = np.lexsort((last, key))
    key, last = key[order], last[order]
    edges = np.flatnonzero((np.diff(key, prepend=-1) != 0) | (np.diff(last, prepend=-1) != 0))
    many, key, last = np.diff(edges, append=len(key)), key[edges], last[edges]
    return key >> 42, key << 21 & (2**63 - 1) | last, many


class Counting:
    """A task's words, trie and runs. ``frequent`` has a bit for each admitted part of up to ``known`` words (0: all are), ``levels``
    the powers of two into which the subtrees of words are split."""

    def __init__(self, frequent: np.ndarray | None, levels: np.ndarray | None, known: int, orders: tuple[int, ...]):
        self.frequent, self.levels, self.known, self.orders = frequent, levels, known, orders
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, dict[bytes, int]] = defaultdict(dict)
        self.names: list[bytes] = [b""]
        self.langs: list[bytes] = [b""]
        self.marks = np.zeros(1, np.int64)
        self.splits = np.zeros(1, np.int64)
        self.counts = np.zeros(1, np.int64)
        self.total: dict[bytes, int] = defaultdict(int)
        self.looked_up = 0
        self.trie = Trie()

    def admitted(self, marks: np.ndarray) -> np.ndarray:
        at = marks & (SLOTS - 1)
        return (self.frequent[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def word_ids(self, lang: bytes, words: list[bytes]) -> np.ndarray:
        """Ids of distinct words, from 1 on; 0 for words that are not frequent."""
        ids = self.ids[lang]
        out = np.fromiter(map(ids.get, words, repeat(-1)), np.int64, len(words))
        unseen = np.flatnonzero(out < 0)
        new = [words[i] for i in unseen.tolist()]
        self.looked_up += len(new)
        kept, size = np.ones(len(new), bool), len(self.names)
        if self.known:
            marks = np.fromiter((slot(lang, word) for word in new), np.int64, len(new))
            kept = self.admitted(marks)
        out[unseen] = np.where(kept, size - 1 + np.cumsum(kept), 0)
        ids.update(zip(new, out[unseen].tolist()))
        self.names += compress(new, kept.tolist())
        self.langs += [lang] * (len(self.names) - size)
        self.marks, self.splits = grown(self.marks, len(self.names)), grown(self.splits, len(self.names))
        if self.known:
            self.marks[size:len(self.names)] = marks[kept]
            self.splits[size:len(self.names)] = (1 << self.levels[marks[kept] & (LEVELS - 1)]) - 1
        return out

    def add(self, lang: bytes, texts: list[bytes]) -> None:
        words, piece = words_in(texts, WORDS)
        if not len(words):
            return
        coded = words.dictionary_encode()
        own = self.word_ids(lang, coded.dictionary.to_pylist())
        if len(self.names) > IDS and self.orders != (1,):
            raise ValueError(f"a piece of text has more than {IDS // 2} different frequent words")
        ids = own[coded.indices.to_numpy()]
        if self.orders == (1,):
            self.counts = grown(self.counts, len(self.names))
            self.counts[own] += np.bincount(coded.indices.to_numpy(), minlength=len(own))
            self.total[lang] += len(words)
            return
        # Whether a pair begins at a word: both words frequent and in one piece, and the pair frequent, if that is known.
        pair = (ids[:-1] > 0) & (ids[1:] > 0) & (piece[:-1] == piece[1:])
        if self.known > 1:
            at = np.flatnonzero(pair)
            pair[at] = self.admitted(pair_slots(self.marks[ids[at]], self.marks[ids[at + 1]]))
        for n in self.orders:
            run = pair[:len(ids) - n + 1].copy()
            for k in range(1, n - 1):
                run &= pair[k:len(ids) - n + 1 + k]
            at = np.flatnonzero(run)
            if len(at):
                self.trie.add(*counted(ids, at, n))

    def run(self, left: int) -> pa.RecordBatch:
        """Subtrees taken out of the trie: a row for each, or for each part of one, with its phrases in order."""
        words, many, rest, n = self.trie.taken(left)
        first = np.repeat(words, many)
        part = self.marks[rest >> 42] >> 32 & self.splits[first]
        order = np.lexsort((rest, first << 31 | part))
        first, rest, n, part = first[order], rest[order], n[order], part[order]
        names, ids = pa.array(self.names, pa.binary()), [rest >> 42, rest >> 21 & (IDS - 1), rest & (IDS - 1)]
        # What follows the first word, and how often: the words of a phrase are joined length by length.
        lines, places = [], []
        for length in range(2, 5):
            mine = np.flatnonzero((ids[length - 2] > 0) & (ids[length - 1] == 0 if length < 4 else True))
            rest_of = pc.binary_join_element_wise(*[names.take(pa.array(i[mine])) for i in ids[:length - 1]], b" ")
            lines.append(pc.binary_join_element_wise(rest_of, pa.array(n[mine]).cast(pa.string()).cast(pa.binary()), b"\t"))
            places.append(mine)
        lines = pa.concat_arrays(lines).take(pa.array(np.argsort(np.concatenate(places))))
        edges = np.flatnonzero(np.append(True, (np.diff(first) != 0) | (np.diff(part) != 0)))
        runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(edges, len(first)), pa.int32()), lines), b"\n")
        word = pa.array(first[edges])
        return pa.RecordBatch.from_arrays(
            [pa.array(self.langs, pa.binary()).take(word).cast(pa.string()), names.take(word).cast(pa.string()), pa.array(part[edges], pa.int32()), runs],
            ["lang", "word", "part", "run"])

    def word_rows(self) -> pa.RecordBatch:
        """The counts of words, and under an empty phrase the number of all words of a language."""
        n = np.append(self.counts[1:len(self.names)], list(self.total.values())).astype(np.int64)
        langs, words = self.langs[1:] + list(self.total), self.names[1:] + [b""] * len(self.total)
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.binary()).cast(pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
            ["lang", "phrase", "n"])

    def full(self) -> Iterator[pa.RecordBatch]:
        """Runs that have to leave: part of a large trie, or everything if there are too many words."""
        if self.looked_up > IDS // 4 or len(self.names) > IDS // 4:
            yield from self.end()
            self.clear()
        elif self.trie.entries > ENTRIES:
            yield self.run(ENTRIES // 2)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.orders == (1,):
            yield self.word_rows()
        elif self.trie.entries:
            yield self.run(0)


def pieces_of(text: bytes) -> list[bytes]:
    """A text, a very long one cut where pieces end."""
    out, start = [], 0
    while len(text) - start > TEXT and (end := PIECE_END.search(text, start + TEXT)):
        out.append(text[start:end.start()])
        start = end.end()
    return [*out, text[start:]]


def runs(filters, known: int, orders: tuple[int, ...]):
    """The words of texts (lang, phrase, n), or their longer phrases as runs (lang, word, part, run); each may come several times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(*(filters.value if known else (None, None)), known, orders)
        for batch in slices(batches, "text", 4 * TEXT):
            of_lang = defaultdict(list)
            for lang, text in zip(utf8(batch.column("lang")), utf8(batch.column("text"))):
                if text:
                    of_lang[lang] += pieces_of(text)
            for lang, texts in of_lang.items():
                size, some = 0, []
                for text in texts:
                    some.append(text)
                    size += len(text)
                    if size > TEXT:
                        counting.add(lang, some)
                        yield from counting.full()
                        size, some = 0, []
                counting.add(lang, some)
                yield from counting.full()
        yield from counting.end()
    return run


def summed(tables: list[pa.Table]) -> pa.Table:
    """The counts (n) of equal phrases (subtree, rest)."""
    sums = pa.concat_tables(tables).group_by(["subtree", "rest"], use_threads=False).aggregate([("n", "sum")])
    return sums.rename_columns(["subtree", "rest", "n"])


def merged(min_count: int):
    """The frequent phrases (lang, phrase, n) of runs that come in order of language, word and part."""
    def rows(of: pa.RecordBatch, first: np.ndarray, sums: pa.Table) -> pa.RecordBatch:
        """The frequent ones of some sums, whose subtrees begin at the rows ``first`` of a batch."""
        sums = sums.filter(pc.greater_equal(sums["n"], min_count)).combine_chunks()
        lang, word = (of.column(c).take(pa.array(first)).take(sums["subtree"].combine_chunks()) for c in ("lang", "word"))
        rest = sums["rest"].combine_chunks()
        phrase = pc.binary_join_element_wise(word.cast(rest.type), rest, pa.scalar(b" ", rest.type))
        return pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase.cast(pa.string()), sums["n"].combine_chunks()], ["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The subtree that may go on: its row and its sums, of which all but the first are not yet added up.
        row, sums = None, []
        for batch in slices(batches, "run", TEXT):
            keys = batch.select(["lang", "word", "part"])
            new = np.zeros(len(keys), bool)
            for column in keys.columns:
                new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            if row and row.select(["lang", "word", "part"]).to_pylist() != keys.slice(0, 1).to_pylist():
                yield rows(row, np.zeros(1, np.int64), summed(sums))
                sums = []
            subtree, first = np.cumsum(new), np.append(0, np.flatnonzero(new))
            lines = pc.split_pattern(batch.column("run"), b"\n")
            halves = pc.split_pattern(lines.flatten(), b"\t", max_splits=1, reverse=True).flatten()
            found = summed([pa.table({
                "subtree": subtree[pc.list_parent_indices(lines).to_numpy()], "rest": halves.take(pa.array(np.arange(0, len(halves), 2))),
                "n": halves.take(pa.array(np.arange(1, len(halves), 2))).cast(pa.string()).cast(pa.int64())})])
            if len(first) > 1:
                sums.append(found.filter(pc.equal(found["subtree"], 0)))
                yield rows(batch, first, summed(sums))
                inner = pc.and_(pc.greater(found["subtree"], 0), pc.less(found["subtree"], len(first) - 1))
                yield rows(batch, first, found.filter(inner))
                found, sums = found.filter(pc.equal(found["subtree"], len(first) - 1)), []
            row = batch.slice(int(first[-1]), 1)
            sums.append(found.set_column(0, "subtree", pa.array(np.zeros(len(found), np.int64))))
            if sum(map(len, sums[1:])) > max(ENTRIES, len(sums[0])):
                sums = [summed(sums)]
        if row:
            yield rows(row, np.zeros(1, np.int64), summed(sums))
    return run


def counted_words(docs: DataFrame, min_count: int) -> DataFrame:
    """(lang, phrase, n) of the words that occur often enough, and under an empty phrase the number of all words."""
    found = docs.mapInArrow(runs(None, 0, (1,)), "lang string, phrase string, n long")
    summed = found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return written(summed.where((F.col("n") >= min_count) | (F.col("phrase") == "")), "phrases-1")


def counted_phrases(docs: DataFrame, filters, known: int, orders: tuple[int, ...], min_count: int) -> DataFrame:
    """(lang, phrase, n) of the phrases of these lengths that occur often enough."""
    found = docs.mapInArrow(runs(filters, known, orders), "lang string, word string, part int, run binary")
    key = ["lang", "word", "part"]
    ordered = found.repartition(*key).sortWithinPartitions(*key)
    return written(ordered.mapInArrow(merged(min_count), "lang string, phrase string, n long"), f"phrases-{orders[0]}")


def part_filters(phrases: DataFrame):
    """On all executors: the bits of frequent phrases, SLOTS of them, and how words' subtrees are split, LEVELS numbers, whatever the corpus."""
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [(lang, *phrase.partition(b" ")) for lang, phrase in zip(utf8(batch.column("lang")), utf8(batch.column("phrase")))]
            at = np.array([slot(lang, word) for lang, word, _, _ in words], np.int64)
            pairs = np.array([space != b"" for _, _, space, _ in words], bool)
            at[pairs] = pair_slots(at[pairs], np.array([slot(lang, second) for lang, _, space, second in words if space], np.int64))
            at, low = at & (SLOTS - 1), at & (LEVELS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(at & 63), pa.array(low), batch.column("n")], ["block", "bit", "low", "n"])

    spark = phrases.sparkSession
    placed = phrases.where("phrase <> ''").mapInArrow(slots, "block long, bit long, low long, n long")
    bits = placed.groupBy("block").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits")).toArrow()  # at most SLOTS / 64 rows
    whole = np.zeros(SLOTS // 64, np.int64)
    whole[bits.column("block").to_numpy()] = bits.column("bits").to_numpy()
    large = placed.where(F.col("n") > WHOLE).groupBy("low").agg(F.ceil(F.log2(F.max("n") / WHOLE)).alias("level")).toArrow()  # at most LEVELS
    levels = np.zeros(LEVELS, np.int64)
    levels[large.column("low").to_numpy()] = large.column("level").to_numpy()
    return spark.sparkContext.broadcast((whole.view(np.uint8), levels))


def phrase_counts(docs: DataFrame, min_count: int = 30, longest: int = 4) -> DataFrame:
    """(lang, phrase, n): all phrases of 1 to ``longest`` words that occur ``min_count`` times in a language.

    An empty phrase stands for the number of all words. Null lang is ``und``, null text empty.
    """
    if not 2 <= longest <= 4:
        raise ValueError("phrases have two to four words")
    texts = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    frequent = F.col("n") >= min_count
    words = counted_words(texts, min_count)
    found = words.unionByName(counted_phrases(texts, part_filters(words.where(frequent)), 1, (2,), min_count))
    if longest == 2:
        return found
    longer = counted_phrases(texts, part_filters(found.where(frequent)), 2, tuple(range(3, longest + 1)), min_count)
    return found.unionByName(longer)


def cut_scores(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Per candidate the cut with the lowest score: l, r and score.

    Very many candidates begin with the same word, so counts of single words are copied and the cuts dealt to the copies.
    """
    word = ~F.contains("part", F.lit(" "))
    salts = F.when(word, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")).withColumn("salt", F.explode(salts))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.array_join(part, " ").alias("part")) for s, part in (
        ("l", F.slice("words", F.lit(1), F.col("k"))), ("r", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))))])
    asked = cuts.select("lang", "phrase", "a", "k", F.inline(sides)).withColumn(
        "salt", F.when(word, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    sided = asked.join(copies, ["lang", "part", "salt"]).groupBy("lang", "phrase", "k").agg(
        F.first("a").alias("a"), F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"),
        F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"))
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    return sided.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a")).alias("best")).select(
            "lang", "phrase", *[F.col(f"best.{c}").alias(c) for c in ("a", "l", "r", "score")])


def uncovered(candidates: DataFrame, share: int) -> DataFrame:
    """Candidates whose words no longer candidate holds in at least ``share`` percent of their occurrences."""
    longer = candidates.where(F.size("words") > 2)
    inner = F.explode(F.expr(
        "flatten(transform(sequence(2, size(words) - 1), n -> transform(sequence(1, size(words) - n + 1), i ->"
        " array_join(slice(words, i, n), ' '))))"))
    held = longer.select("lang", F.col("a").alias("held"), inner.alias("phrase")).groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    gone = F.coalesce(F.lit(100) * wide("held") >= F.lit(share) * wide("a"), F.lit(False))
    return candidates.join(held, ["lang", "phrase"], "left").where(~gone).drop("held")


def collocations(docs: DataFrame, min_count: int = 30, longest: int = 4, share: int = 80, top: int = 2000) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A to Z), cut into pieces at ``.,;:!?`` and line ends, and into words at spaces and tabs;
    phrases do not reach over pieces. ``a`` is a phrase's count, ``l`` and ``r`` those of its two sides at the cut that
    scores lowest (ties: the first cut), the score floor(2,000,000 a / (l + r)), ``n`` the language's number of words. A
    phrase that mostly (``share`` percent) occurs inside one longer candidate is left out. Ties in rank go by count and
    then by the phrase's bytes, so reruns agree. Null lang counts as ``und``, null text as empty; repeated rows count each. A
    language without frequent phrases, and an empty table, give no rows. Very long texts are counted whole, in parts that
    end with pieces.
    """
    counts = phrase_counts(docs, min_count, longest)
    phrases = counts.where((F.col("n") >= min_count) & F.contains("phrase", F.lit(" ")))
    candidates = phrases.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    scored = cut_scores(uncovered(candidates, share), counts)
    best = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = scored.withColumn("rank", best.cast("long")).where(F.col("rank") <= top)
    totals = counts.where("phrase = ''").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
