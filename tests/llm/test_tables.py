"""Mixing, archives, neighbours, packing and the pipeline against plain versions."""

import base64
import gzip
import hashlib
import io
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foldex.llm import archive, mixing, neighbours, packing
from foldex.llm.queries import word_tokenizer


# --- mixing ------------------------------------------------------------------------------------

def plain_targets(sizes):
    """Share by weight, cut at three times the size, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, fixed = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in fixed)
        free = [s for s in names if s not in fixed]
        target = {s: 3.0 * sizes[s] for s in fixed} | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        fixed |= above


def check_mix(rows, got):
    size = [len((t or "").split()) for _, t, *_ in rows]
    sources = [m[1] if m else "a" for _, _, *m in rows]
    sizes = defaultdict(int)
    for s, n in zip(sources, size):
        sizes[s] += n
    target = plain_targets(sizes)
    want = Counter((i, n, sizes[s]) for (i, *_), n, s in zip(rows, size, sources))
    assert Counter((r.doc_id, r.size, r.source_size) for r in got) == want
    by_id = {i: s for (i, *_), s in zip(rows, sources)}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        s = by_id[r.doc_id]
        assert r.target == pytest.approx(target[s], abs=1e-6)
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        assert r.taken >= r.size * math.floor(target[s] / max(1, sizes[s]) - 1e-9)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)


def test_mix(documents):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["word"] * int(rng.integers(0, 300))) or None, "en", s)
            for i, s in enumerate(rng.choice(["a", "b", "c", "ä", "Z"], 600, p=[0.5, 0.2, 0.1, 0.15, 0.05]))]
    rows += [(1000 + i, "x y", "en", None) for i in range(5)] + [(2000, "", "en", "empty")]
    docs = documents(rows, clash=True)
    first, again = mixing.mixed_sources(docs).collect(), mixing.mixed_sources(docs.repartition(7)).collect()
    check_mix(rows, first)
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_mix_of_hard_texts(documents, hard_texts):
    got = mixing.mixed_sources(documents(hard_texts, clash=True)).collect()
    check_mix(hard_texts, got)
    assert mixing.mixed_sources(documents([])).collect() == []
    assert {(r.size, r.taken, r.target) for r in mixing.mixed_sources(documents([(1, None), (2, " ")])).collect()} == {(0, 0, 0.0)}


def test_mixture_repeats_whole_documents(documents):
    docs = documents([(i, "w " * 10, "en", s) for i, s in enumerate("abcccccccc")] + [(50, None, "en", "a")], clash=True)
    times = {(r.doc_id): r.taken // 10 for r in mixing.mixed_sources(docs).collect()}
    out = mixing.mixture(docs)
    assert out.dtypes == docs.dtypes
    assert Counter(r.doc_id for r in out.collect()) == Counter({i: n for i, n in times.items() if n})


def test_high_quality_documents_come_first(documents):
    rows = [(i, "letters only here " if i % 2 else "1234 5678 9 ", "en", "a") for i in range(4000)] + [(9999, "x " * 30_000, "en", "b")]
    got = mixing.mixed_sources(documents(rows)).where("doc_id < 4000").collect()
    chosen = Counter(r.doc_id % 2 for r in got if r.taken > got[0].size * (min(r.taken for r in got) // 3))
    assert chosen[1] > 1.5 * chosen[0] or min(r.taken for r in got) == max(r.taken for r in got)


# --- archives ----------------------------------------------------------------------------------

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit(7) for c in ("record", "digest", "size", "refers_to", "content", "n")})


def test_archives(spark):
    html = "<html>é\r\n\r\nWARC/1.0\r\nx"
    rows = [(i, f"http://a/{i}", html) for i in range(40)] + [(100, None, None), (101, "", ""), (102, "http://é x\n/", "own"), (103, "u", "x" * 300_000)]
    rows += [(None, "http://none", html), (None, "http://alone", "only one")]
    got = archive.archived(pages(spark, rows)).collect()
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(i, largest.get(h or "", -1))
    want = Counter()
    for i, _, h in rows:
        data, best = (h or "").encode(), largest.get(h or "")
        own = best is None or i == best
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if own else "revisit", None if own else best)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert len({r.warc_id for r in got}) == len(rows)
    assert archive.archived(pages(spark, [])).collect() == []


def test_pages_named_like_file_headers(spark):
    for urls in (["http://a", "filedesc://b", "http://c"], ["filedesc://a", "http://b", "filedesc://own.arc"]):
        got = archive.archived(pages(spark, [(i, u, f"page {i}") for i, u in enumerate(urls)]).coalesce(1)).collect()
        assert {(r.page_id, r.target_uri, r.payload_bytes) for r in got} == {(i, u, 6) for i, u in enumerate(urls)}


def test_repeated_pages(spark):
    got = archive.archived(pages(spark, [(1, "u", "same"), (1, "u", "same"), (0, "v", "same")])).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in got) == Counter(
        {(1, "response", None): 2, (0, "revisit", 1): 1})


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    records = [("http://a/b c", "20200102030405", "text/html", b"HTTP/1.1 200 OK\r\n\r\nbody\n\nhttp://x 0.0.0.0 1 text 5\n"),
               ("dns:a", "2020", "text/dns", b"\x00\xff"), ("http://e", "19991231235959", "text/plain", b"")]
    got = list(archive.parse_arc(archive.arc_file(records, version)))
    assert [(r["URL"], r["Archive-date"], r["Content-type"], r["content"]) for r in got] == [
        (u.replace(" ", "%20"), d, k, c) for u, d, k, c in records]
    warc = b"".join(archive.warc_record(r, {}) for r in got)
    back = list(archive.parse_warc(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(warc)))))
    assert [f["WARC-Type"] for f, _ in back] == ["response", "metadata", "resource"]
    assert [f["WARC-Date"] for f, _ in back] == ["2020-01-02T03:04:05Z", "2020-01-01T00:00:00Z", "1999-12-31T23:59:59Z"]
    assert [b for _, b in back] == [c for *_, c in records]
    assert back[0][0]["WARC-Payload-Digest"] == "sha1:" + archive.sha1_base32(records[0][3].partition(b"\r\n\r\n")[2])


def test_broken_archives_are_refused():
    whole = archive.arc_file([("http://a", "2020", "text/html", b"0123456789")], 1)
    for bad in (whole[:-5], whole.replace(b" 10\n", b" ten\n"), b"no header"):
        with pytest.raises(ValueError):
            list(archive.parse_arc(bad))


# --- neighbours --------------------------------------------------------------------------------

def plain_nearest(rows, top=20):
    """Brute force over rows; per query id the neighbours of each of its rows, one after another."""
    vectors = []
    for i, v in rows:
        if i is None or v is None or any(x is None for x in v):
            continue
        x = np.array(v, float)
        if np.isfinite(x).all() and x.any():
            vectors.append((i, x))
    out = defaultdict(list)
    for at, (q, v) in enumerate(vectors):
        if q % 20 == 0:
            scored = sorted((-float(v @ x), i) for k, (i, x) in enumerate(vectors) if k != at and len(x) == len(v))
            out[q] += [(i, -s) for s, i in scored[:top]]
    return out


def nearest(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(7) for c in ("node", "vec", "curve", "block", "label")})
    out = defaultdict(list)
    for r in sorted(neighbours.nearest(df).collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score, r.rank))
    return out


def recall(want, got):
    assert set(want) == {q for q in want if got[q] or not want[q]}
    hits = sum(len({i for i, _ in want[q]} & {i for i, *_ in got[q]}) for q in want)
    return hits / sum(map(len, want.values()))


def test_neighbours_with_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, 8) / 4]) for i in range(1200)]
    rows += [(5000 + i, [1.0, 0.5, 0.25, 0.0, 0.0, 0.0, 0.0, -1.0]) for i in range(700)]
    rows += [(7000, None), (7020, []), (7040, [0.0] * 8), (7060, [float("nan")] + [1.0] * 7), (7080, [None] + [1.0] * 7),
             (7100, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]
    want, got = plain_nearest(rows), nearest(spark, rows)
    assert set(got) <= set(want) and recall(want, got) >= 0.9
    for q, found in got.items():
        assert [r for *_, r in found] == list(range(1, 21))
        assert [(-s, i) for i, s, _ in found] == sorted((-s, i) for i, s, _ in found)
    # The queries among the copies find the copies with the smallest ids.
    for q in range(5000, 5700, 20):
        if want[q][19][1] == want[q][0][1]:
            assert [i for i, *_ in got[q]] == [i for i, _ in want[q]]


def test_every_length_and_repeated_ids_are_searched(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, 2 + i % 3)]) for i in range(300)]
    rows += [(20, rows[20][1]), (40, [1.0, 2.0]), (40, [3.0, 1.0, 1.0]), (7, [9.0, 9.0]), (9000, [1.0] * 17)]
    want, got = plain_nearest(rows), nearest(spark, rows)
    assert {q: Counter(found) for q, found in want.items() if found} == {q: Counter((i, s) for i, s, _ in found) for q, found in got.items()}
    assert len(got[40]) == 60 and len(got[20]) == 40
    assert sorted(r for *_, r in got[40]) == sorted(list(range(1, 21)) * 3)
    assert 20 in [i for i, *_ in got[20]]  # the other row of that id


def test_few_vectors_give_all(spark):
    rows = [(i, [float(i + 1)] * 8) for i in range(5)]
    assert [(i, s) for i, s, _ in nearest(spark, rows)[0]] == [(4, 40.0), (3, 32.0), (2, 24.0), (1, 16.0)]
    assert nearest(spark, []) == {} and nearest(spark, [(0, [1.0] * 8)]) == {}


def test_recall_on_the_table(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    want = {}
    for at in np.flatnonzero(ids % 20 == 0):
        s = x @ x[at]
        s[at] = -np.inf
        want[ids[at]] = [(i, s) for i in ids[np.lexsort((ids, -s))[:20]]]
    assert recall(want, nearest(spark, rows)) >= 0.9


def test_hilbert_steps_to_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = neighbours.hilbert(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


# --- packing -----------------------------------------------------------------------------------

def check_pieces(rows, got, capacity=2048):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(word_tokenizer())
    want = Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start:start + capacity], "<u4")
            want[(i, k, start, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(sequences)


def test_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = packing.pack(docs, word_tokenizer()).collect()
    used = check_pieces([(r.doc_id, r.text) for r in docs.collect()], got)
    assert used <= packing.lower_bound(Counter(r.length for r in got), 2048) + 1


def test_packing_of_hard_texts(documents, hard_texts):
    rows = hard_texts + [(100, "I can't. DON'T... 'tis <|endoftext|> <|ENDOFTEXT|> İstanbul ΣΑΣ é x y z a.b, c!? 12,5; x:y . , ,,"), (101, "a " * 2047), (102, "a " * 2048)]
    # Capitals before marks that make another letter of both, and marks that do not.
    rows += [(200 + i, f"x{a}{m}y {a}{m} A{a}{m}{m} é{a}{m}") for i, (a, m) in enumerate(
        (a, m) for a in "JHTWYAZ" for m in "\u030c\u0331\u0308\u030a\u0301\u0327")]
    check_pieces(rows, packing.pack(documents(rows, clash=True), word_tokenizer()).collect())
    assert packing.pack(documents([]), word_tokenizer()).collect() == []


def same_ids(words, texts):
    ids, ends = words.of([t.encode() for t in texts])
    for text, start, end in zip(texts, np.append(0, ends[:-1]), ends):
        assert ids[start:end].tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids + [0], ascii(text)


def test_words_are_encoded_once_whatever_stands_by_them():
    words = packing.WordIds(word_tokenizer())
    same_ids(words, ["Word word, (word) word!! word###", "élan élan, élan... 12 word21 21.12 don't don't,"])
    assert set(words.places) == {b"\n", *"word , ( ) !! ### élan ... 1 2 . don't".encode().split()}


def test_ids_of_cut_words():
    """Every place where letters, digits, marks and apostrophes meet characters beyond ASCII, with words dropped on the way."""
    odd = [*"éÉßçñ×÷İſKÅΣς漢é각ªº²٣—«’\x85\xa0\u3000\u0338\u0301\u0307😀\ufb01", "e\u0301", "\u1100\u1161"]
    plain = [*"abstIEJH019.,;'\"<>=#-\t\x0b\x1c\n   ", "'s", "'LL", "don't"]
    words = packing.WordIds(word_tokenizer())
    same_ids(words, [f"a{c},b {c}.x {c} {c}5 .{c} {c}'s" for c in odd] + [f"{a}{b}{c}" for a in plain for b in odd for c in plain])
    rng = np.random.default_rng(9)
    for _ in range(30):
        same_ids(words, ["".join(rng.choice(odd if rng.random() < 0.2 else plain) for _ in range(20)) for _ in range(30)])
    same_ids(words, ["Élan, x<|endoftext|>Y's 12 <|ENDOFTEXT|>."])


def test_words_used_again_are_kept(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 12)
    words = packing.WordIds(word_tokenizer())
    for k in range(4):
        same_ids(words, ["the same words", f"and some{'abcd'[k]} other{'abcd'[k]}, new{'abcd'[k]}"])
        assert {b"the", b"same", b"words", b"and", b"\n"} <= set(words.places) and len(words.places) <= 12
    same_ids(words, [" ".join(f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz")])
    same_ids(words, ["the same words"])


def test_ids_come_along(documents):
    got = packing.pack(documents([(1, "some words")]), word_tokenizer(), keep_ids=True).first()
    assert zlib.crc32(got.ids) == got.ids_crc32 and len(got.ids) == 4 * got.length


def least_bins(sizes, capacity):
    """The fewest bins, by trying everything."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]
    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= sizes[k]:
                at = rooms.index(room)
                go(k + 1, rooms[:at] + [room - sizes[k]] + rooms[at + 1:])
        go(k + 1, rooms + [capacity - sizes[k]])
    go(0, [])
    return best[0]


def test_bin_completion_is_close_to_the_best():
    rng = np.random.default_rng(6)
    over = 0
    for _ in range(150):
        sizes = [int(x) for x in rng.integers(10, 60, rng.integers(1, 11))]
        bins = packing.bin_completion(Counter(sizes), 100)
        assert Counter(x for b in bins for x in b) == Counter(sizes) and all(sum(b) <= 100 for b in bins)
        assert packing.lower_bound(Counter(sizes), 100) <= least_bins(sizes, 100) <= len(bins)
        over += len(bins) - least_bins(sizes, 100)
    assert over <= 1


def test_bin_completion_beats_best_fit():
    """Seven pieces to a sequence, which best fit does not find."""
    for sizes, capacity, least in ((Counter({300: 70, 290: 70, 280: 70, 270: 30}), 2048, 35), (Counter([44, 24, 24, 22, 21, 17, 8, 8, 6, 6]), 61, 3)):
        bins = packing.bin_completion(sizes, capacity)
        assert sum((Counter(b) for b in bins), Counter()) == sizes and all(sum(b) <= capacity for b in bins)
        assert packing.lower_bound(sizes, capacity) <= len(bins) == least < len(packing.best_fit(sizes, capacity))


def test_fillings_are_undominated_and_all_there():
    sizes = packing.Sizes(Counter({9: 1, 7: 2, 5: 2, 4: 1, 2: 1}))
    found = {f for f in packing.fillings(sizes, 14) if f is not None}
    assert (7, 7) in found and (9, 5) in found and (7, 5, 2) in found and (5, 5, 4) in found
    assert all(sum(f) <= 14 for f in found) and (7, 4) not in found
    assert list(packing.fillings(sizes, 1)) == [()]


# --- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.dtypes, {r.doc_id for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.dtypes == columns
        assert {r.doc_id for r in docs.collect()} <= ids
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    check_pieces([(r.doc_id, r.text) for r in docs.collect()], last)
    run = corpus_pipeline.run(spark, sf_dir).collect()
    kind = lambda rows: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert kind(run) == kind(last)


def test_pipeline_of_hard_texts(spark, documents, hard_texts):
    docs = documents(hard_texts, clash=True)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, ""), "test-hard")
    assert docs.count() > 0
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, ""), "test-empty")
    assert docs.count() == 0


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    import gzip
    monkeypatch.setattr(archive, "BYTES_PER_FILE", 1_000_000)
    monkeypatch.setattr(archive, "RECORDS_PER_FILE", 100)
    rows = [(i, f"http://h/{i}", f"{i} " * (50 if i % 3 else 30_000)) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    archive.write_warc(pages, str(tmp_path / "warc"))
    sizes = [len(gzip.decompress(f.read_bytes())) for f in (tmp_path / "warc").glob("part-*")]
    assert max(sizes) <= 1_000_000
    got = {r.page_id: r.payload_bytes for r in archive.read_warc(spark, str(tmp_path / "warc")).collect()}
    assert got == {i: len(h) for i, _, h in rows}
