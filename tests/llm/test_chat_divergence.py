"""Chat formatting by round trip and plain digests; the divergence audit against plain arithmetic."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from foldex.llm import chat, divergence
from foldex.llm.chat import Encoder, escape, format_conversations, loss_mask, parse, read_back, render, unescape
from foldex.llm.divergence import source_divergence

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = ["", "\\", "\\\\", "<|", "<\\|", "\\<|endoftext|>", "<|endoftext|>", "<<|endoftext|>", "a\n\n", " lead and trail ", "😀👩‍👩‍👧 漢字 é́",
        r"\### Assistant: </turn> ok", "\x00\x01\r\n\t", "<", "|", "<\\", "x" * 3000, "don't 's 1234 -- ...", " \xa0 　"]


# --- chat ----------------------------------------------------------------------------------------

def test_escapes_are_reversible_and_hide_markers():
    for text in [*HARD, *[a + b for a in HARD for b in HARD]]:
        assert unescape(escape(text)) == text and chat.MARKER not in escape(text)
    turns = [(role, text) for role in ("user", "assistant", "", "<|endoftext|>\\") for text in HARD]
    text, spans = render(turns, "assistant")
    assert parse(text) == turns
    assert [unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def test_masked_tokens_are_the_answers(encoder):
    turns = [(role, text) for text in HARD for role in ("user", "assistant")]
    text, spans = render(turns, "assistant")
    ids, starts, ends = encoder.encode(text)
    mask = loss_mask(starts, ends, spans)
    plain = np.array([any(a <= s and e <= b for a, b in spans) for s, e in zip(starts, ends)])
    assert (mask == plain).all()
    assert chat.learned_text(text, starts, mask) == "".join(t for r, t in turns if r == "assistant")
    assert encoder.tokenizer.decode(ids.tolist(), skip_special_tokens=False) == text
    assert not loss_mask(starts, ends, []).any() and len(encoder.encode("")[0]) == 0


def test_long_texts_are_encoded_as_a_whole_would_be(encoder, monkeypatch):
    text, _ = render([("user", "It's one's word, don't  split 12 ab!\n\nnow " * 300), ("assistant", "日本語 text " * 300)], "assistant")
    whole = encoder.encode(text)
    monkeypatch.setattr(chat, "SEGMENT", 100)
    for a, b in zip(whole, encoder.encode(text)):
        assert (a == b).all()


def plain_digests(rows):
    """Per conversation, from its sorted turns."""
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = set()
    for conv, turns in of.items():
        said = [(r, t) for *_, r, t in sorted(turns)]
        learned = "".join(t for r, t in said if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        size = sum(3 * len("<|endoftext|>") + len(escape(r)) + len(escape(t)) for r, t in said)
        out.add((conv, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(learned), sha(learned), size))
    return out


def digests(df):
    return {tuple(r[c] for c in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")) for r in df.collect()}


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_conversations_of_every_kind(spark):
    rows = [(c, t, ["user", "assistant", "system", None][(c + t) % 4], HARD[(c * 5 + t) % len(HARD)]) for c in range(40) for t in range(c % 9 + 1)]
    rows += [(None, 1, "user", "no number"), (None, None, "assistant", None), (5, None, "assistant", "before all"), (5, 0, "user", "tied"),
             (5, 0, "assistant", "tied"), (5, 0, "assistant", "tied"), (99, 0, None, None), (-7, 3, "assistant", "x")]
    # A conversation with a third of all turns is shared by tasks.
    rows += [(1000, t, "assistant" if t % 2 else "user", f"turn {t} of many, " * 20) for t in range(400)]
    df = conversations(spark, rows).repartition(6)
    assert digests(read_back(format_conversations(df, PATH))) == plain_digests(rows)
    clash = df.selectExpr("*", "1 as part", "2 as formatted", "3 as loss", "4 as ids", "5 as n_turns")
    assert digests(read_back(format_conversations(clash, PATH))) == plain_digests(rows)


def test_formatted_rows_hold_texts_and_tokens(spark, encoder):
    rows = [(1, 0, "user", "hello <|endoftext|>"), (1, 1, "assistant", "hi \\ there"), (2, 0, "assistant", "")]
    found = {r.conv_id: r for r in format_conversations(conversations(spark, rows), PATH).collect()}
    assert parse(found[1].formatted) == [("user", "hello <|endoftext|>"), ("assistant", "hi \\ there")]
    ids, starts, _ = encoder.encode(found[1].formatted)
    assert found[1].ids == ids.tolist() and found[1].starts == starts.tolist() and any(found[1].loss) and not any(found[2].loss)
    assert format_conversations(conversations(spark, rows).limit(0), PATH).count() == 0
    assert read_back(format_conversations(conversations(spark, rows).limit(0), PATH)).count() == 0


def test_readers_hold_little(monkeypatch):
    """A conversation beyond the bound leaves its digest to the second pass, in parts."""
    monkeypatch.setattr(chat, "SEGMENT", 300)
    monkeypatch.setattr(chat, "HELD", 500)
    rows = [(c, t, "assistant" if t % 2 else "user", f"turn {t} says " * 10) for c, n in ((1, 4), (2, 60), (3, 2), (4, 3)) for t in range(n)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows])
    formatted = list(chat.format_rows(PATH, "assistant")(iter([batch.slice(0, 30), batch.slice(30)])))
    read = pa.Table.from_batches(list(chat.read_rows(iter(formatted)))).to_pylist()
    assert [r["conv_id"] for r in read if r["turns"] is None] == [3]
    assert sum(r["conv_id"] == 2 for r in read) > 5
    parts = sorted((r for r in read if r["turns"] is not None), key=lambda r: (r["conv_id"], r["turn"], r["part"]))
    joined = pa.Table.from_batches(list(chat.joined_rows(iter([pa.RecordBatch.from_pylist(parts, schema=pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("turns", pa.binary()), ("loss", pa.binary())]))])))).to_pylist()
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    assert {tuple(r[c] for c in names) for r in joined + [r for r in read if r["turns"] is None]} == plain_digests(rows)


# --- divergence ------------------------------------------------------------------------------------

def plain_audit(rows, min_docs=3, top=200):
    terms, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups[lang].add(source)
        terms[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        whole = Counter()
        for s in sources:
            whole.update({t: terms[lang, s][t] for t in kept})

        def p(counts):
            base = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // base for t in kept}
        ps, q = {s: p(terms[lang, s]) for s in sources}, p(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode()) for o in sources - {s}]
            own = [(-f(ps[s][t], q[t]), t.encode()) for t in kept if terms[lang, s][t] and ps[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", own, top)):
                out |= {(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(sorted(items)[:most], 1)}
    return out


def audited(df):
    rows = df.collect()
    found = {tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in rows}
    assert len(found) == len(rows)
    return found


def test_audit_equals_plain_arithmetic(spark, documents):
    words = "Alpha beta gamma Über straße don't x_y z9 the The THE of 漢字 é".split(" ")
    rows = [(i, " ".join(words[(i * j + j) % (3 + i % 11)] for j in range(i % 23)), ["en", "de", None][i % 3 and i % 2 + 1], "s%d" % (i * i % 7))
            for i in range(150)]
    rows += [(900, "only one here", "fr", "a"), (901, None, "fr", None), (902, "", "xx", "lone"), (903, "9 1 _", None, "digits")]
    df = documents([(i, t, (lang, s)) for i, t, lang, s in rows], clash=True).repartition(5)
    assert audited(source_divergence(df)) == plain_audit(rows)
    assert audited(source_divergence(df, min_docs=1, top=3)) == plain_audit(rows, 1, 3)


def test_audit_of_odd_texts(spark, documents, hard_texts):
    rows = [(i, t, "en", "s%d" % ((i or 0) % 3)) for i, t in hard_texts] * 2
    df = documents([(i, t, (lang, s)) for i, t, lang, s in rows])
    assert audited(source_divergence(df)) == plain_audit(rows)
    assert source_divergence(df.limit(0)).count() == 0


def test_audit_of_the_given_documents(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in table.collect()]
    assert audited(source_divergence(table)) == plain_audit(rows)


def test_long_texts_count_once(monkeypatch):
    """A text that is cut for counting is one document still."""
    monkeypatch.setattr(divergence, "TEXT", 50)
    text = "some words and some other words été " * 20
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en"], "source": ["a", "b"], "text": [text, "short words"]})
    rows = [r for b in divergence.term_counts(iter([batch])) for r in b.to_pylist()]
    assert {(r["source"], r["term"]): (r["n"], r["docs"]) for r in rows} == {
        **{("a", t): (n, 1) for t, n in Counter(text.split()).items()}, ("b", "short"): (1, 1), ("b", "words"): (1, 1)}


def test_runs_and_shares_are_exact():
    lengths = np.array([3, 1, 4, 2, 5])
    at, source, n = np.array([0, 1, 3, 4]), np.array([0, 0, 0, 2]), np.array([7, 7, 7, 1])
    runs = divergence.columns_of(lengths, at, source, n, 3)
    assert [(b.tolist(), v.tolist()) for b, v in runs] == [([4, 8, 10, 15], [7, 0, 7, 0]), ([15], [0]), ([10, 15], [0, 1])]
    counts, base = np.array([0, 5, 10**15, 123456789012345]), 3 * 10**15 + 7
    assert divergence.shares(counts, base).tolist() == [1 + 10**9 * (int(c) + 1) // base for c in counts]
