"""Phrase mining against a plain count, whatever the sizes of tries and containers."""

import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from foldex.llm import phrases
from foldex.llm.phrases import Trie, collocations, phrase_counts

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(rows, min_count, longest=4, share=80, top=2000):
    """Counts all phrases of all lengths, then scores, filters and ranks them one by one."""
    f, total = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = lang if lang is not None else "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, count in f.items():
        wanted = {p: a for p, a in count.items() if len(p) > 1 and a >= min_count}
        inside = Counter()
        for p, a in wanted.items():
            for sub in {p[i:i + n] for n in range(2, len(p)) for i in range(len(p) - n + 1)}:
                inside[sub] = max(inside[sub], a)
        scored = []
        for p, a in wanted.items():
            if 100 * inside[p] >= share * a:
                continue
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def corpus():
    words = "the cat sat on a mat and then red fox ran off Über straße the the".split(" ")
    rows = []
    for i in range(120):
        text = " ".join(words[(i * 7 + j * j) % len(words)] for j in range(40))
        text += ". New York City, new york city; NEW YORK\tcity! a a a a a\nthe end\x0bof it" + (" : hapax%d" % i)
        rows.append((i, text, ["en", "de", None][i % 3 if i % 2 else 0], "s"))
    return rows


@pytest.mark.parametrize("share,longest,top", [(80, 4, 2000), (100, 3, 5), (50, 2, 2000)])
def test_equals_a_plain_count(spark, documents, share, longest, top):
    rows = corpus()
    df = documents([(i, t, (lang, s)) for i, t, lang, s in rows], clash=True).repartition(5)
    assert got(collocations(df, 5, longest, share, top)) == plain(rows, 5, longest, share, top)


def test_small_tries_spill_and_burst_alike(monkeypatch):
    """The runs of a task add up to the plain counts, however often they are spilled."""
    for name, value in (("ENTRIES", 40), ("BURST", 3), ("TEXT", 500), ("IDS", 1 << 21)):
        monkeypatch.setattr(phrases, name, value)
    rows = corpus()
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "und" for r in rows], "text": [r[1] for r in rows]})
    filters = SimpleNamespace(value=(np.full(phrases.SLOTS // 8, 255, np.uint8), np.arange(phrases.LEVELS) % 3))
    want = Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            words = re.findall(r"[^ \t]+", piece)
            want[lang or "und", ""] += len(words)
            want.update((lang or "und", " ".join(words[i:i + n])) for n in (1, 2, 3, 4) for i in range(len(words) - n + 1))
    batches = [batch.slice(0, 50), batch.slice(50)]
    found = Counter()
    for run in phrases.runs(None, 0, (1,))(iter(batches)):
        for lang, phrase, n in zip(*[run.column(c).to_pylist() for c in ("lang", "phrase", "n")]):
            found[lang, phrase] += n
    for known, orders in ((1, (2,)), (2, (3, 4))):
        some = list(phrases.runs(filters, known, orders)(iter(batches)))
        assert len(some) > 5
        runs = pa.Table.from_batches(some).sort_by([("lang", "ascending"), ("word", "ascending"), ("part", "ascending")])
        assert max(runs.column("part").to_pylist()) == 3
        for out in phrases.merged(1)(iter(runs.to_batches(max_chunksize=7))):
            for lang, phrase, n in zip(*[out.column(c).to_pylist() for c in ("lang", "phrase", "n")]):
                assert (lang, phrase) not in found
                found[lang, phrase] = n
    assert found == want


def test_pairs_cost_no_hash_of_their_own(monkeypatch):
    """A task hashes each word once and no pair: the hashes of pairs follow from those of their words."""
    rows, asked, slot = corpus(), [], phrases.slot
    monkeypatch.setattr(phrases, "slot", lambda lang, words: asked.append((lang, words)) or slot(lang, words))
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "und" for r in rows], "text": [r[1] for r in rows]})
    filters = SimpleNamespace(value=(np.full(phrases.SLOTS // 8, 255, np.uint8), np.zeros(phrases.LEVELS, np.int64)))
    assert list(phrases.runs(filters, 2, (3, 4))(iter([batch, batch])))
    assert len(asked) == len(set(asked)) and not any(b" " in words for _, words in asked)


def test_hashes_of_pairs_tell_order_and_language():
    words = [phrases.slot(lang, word) for lang in (b"en", b"de") for word in (b"a", b"b", b"c")]
    left, right = (np.array([p[i] for p in ((x, y) for x in words for y in words)]) for i in (0, 1))
    hashes = phrases.pair_slots(left, right)
    assert len(set(hashes.tolist())) == len(words) ** 2 and hashes.min() >= 0


def test_a_subtree_over_many_batches_is_merged_whole(monkeypatch):
    """Its lines are added up once there are enough of them, whatever the batches; the next subtree is another."""
    monkeypatch.setattr(phrases, "TEXT", 10)
    monkeypatch.setattr(phrases, "ENTRIES", 3)
    runs = [("en", "a", 0, b"b\t2\nb c\t1")] * 20 + [("en", "a", 1, b"b\t1")] + [("en", "b", 1, b"b\t3\nc\t1")] * 2 + [("es", "b", 1, b"b\t4")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*runs)], ["lang", "word", "part", "run"])
    for size in (1, 2, 21, 24):
        pieces = [batch.slice(i, size) for i in range(0, len(batch), size)]
        found = [tuple(r.values()) for out in phrases.merged(2)(iter(pieces)) for r in out.to_pylist()]
        assert sorted(found) == [("en", "a b", 40), ("en", "a b c", 20), ("en", "b b", 6), ("en", "b c", 2), ("es", "b b", 4)]


def test_a_trie_takes_out_whole_subtrees():
    trie = Trie()
    for _ in range(2):
        trie.add(np.array([1, 1, 2]), np.array([5 << 42, 6 << 42, 5 << 42]), np.array([3, 1, 2]))
    taken = list(trie.take(1))
    assert [(w, dict(zip(r.tolist(), n.tolist()))) for w, r, n in taken] == [(1, {5 << 42: 6, 6 << 42: 2})]
    assert trie.entries == 1 and [t[0] for t in trie.take(0)] == [2] and trie.entries == 0


def test_odd_texts_and_empty_tables(spark, documents, hard_texts):
    rows = [(i, t, "en", "s") for i, t in hard_texts] * 3
    df = documents([(i, t, (lang, s)) for i, t, lang, s in rows])
    assert got(collocations(df, 4)) == plain(rows, 4)
    assert collocations(df.limit(0)).count() == 0
    assert collocations(df, 10**9).count() == 0
    with pytest.raises(ValueError):
        phrase_counts(df, longest=5)


def test_exact_beyond_64_bits(spark):
    """Scores of counts whose products pass 64 bits."""
    from pyspark.sql import functions as F
    big = 2**62
    counts = spark.createDataFrame([("en", "x", big), ("en", "y", big - 1), ("en", "x y", big - 3)], "lang string, phrase string, n long")
    candidates = counts.where("phrase = 'x y'").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    row = phrases.cut_scores(candidates, counts).first()
    assert (row.l, row.r, row.score) == (big, big - 1, 2_000_000 * (big - 3) // (2 * big - 1))


def test_the_given_documents(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in table.collect()]
    assert got(collocations(table, 10)) == plain(rows, 10)
