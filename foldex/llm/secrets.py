"""Secret scans: known forms, and high-entropy strings found by sliding windows.

Everything is column expressions. A regular expression gives its matches and, used to split the text,
the gaps between them, so match positions are running sums of lengths. Candidate strings beyond the
known forms are cut where a base span or an allow-listed part stands, and every segment that is left
is scored per character class: a window slides along it, counts of its characters are kept up by one
character in and one out, and the window's Shannon entropy follows from a table of n log n. Windows
above the class's threshold make the span.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind and pattern of the base spans, in the order in which spans with one start are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are maximal, so asking for their least length in the pattern finds the same ones.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Parts in an alphabet that has neither two cases nor separators are segments of their own.
PART = r"(?<![A-Za-z0-9])(?:[a-z0-9]{20,}+|[A-Z0-9]{20,}+|[0-9A-Fa-f]{20,}+)(?![A-Za-z0-9])"
#: Bits per character above which a window counts: hexadecimal digits; letters of one case with digits; letters of one
#: case; letters of both cases; both with digits beside letters; words and numbers side by side. Measured figures are in the README.
THRESHOLD = {"hex": 3.0, "lower": 3.5, "upper": 3.5, "word": 3.9, "letters": 4.0, "mixed": 3.8, "joined": 4.05}
#: What is no secret though it looks random: identifiers, and parts of strings with placeholders or counting.
ALLOW = (
    r"(?i)(?<![0-9a-z])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9a-z])",
    r"(?i)example|sample|placeholder|changeme|xxxx|0123456789|1234567890|abcdefgh",
)


SPANS = "array<struct<start: int, end: int, found: string>>"
#: Rows of a list that are worked through at once. A list grows by copying, so long ones are put together from short ones.
CHUNK = 128


def running(rows: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> tuple[Column, Column]:
    """Goes through ``rows`` with a state: the lists that ``step`` gives for each row, joined, and the last state.

    ``step`` maps state and row to the next state and a list of type ``kind``. The time is in proportion to the rows.
    """
    empty = F.array().cast(kind)

    def bound(value: Column, use: Callable[[Column], Column]) -> Column:
        # An element of a list of one is made once, however often it is used.
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def of_row(state: Column, row: Column) -> Column:
        after, out = step(state["state"], row)
        return F.struct(after.alias("state"), F.concat(state["out"], out).alias("out"))

    def of_chunk(state: Column, chunk: Column) -> Column:
        whole = F.aggregate(chunk, F.struct(state["state"].alias("state"), empty.alias("out")), of_row)
        return bound(whole, lambda w: F.struct(w["state"].alias("state"), F.concat(state["parts"], F.array(w["out"])).alias("parts")))

    chunks = bound(rows, lambda r: F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(r), F.lit(1)) - 1) / CHUNK).cast("int")), lambda k: F.slice(r, k * CHUNK + 1, F.lit(CHUNK))))
    done = F.aggregate(chunks, F.struct(start.alias("state"), F.array().cast(f"array<{kind}>").alias("parts")), of_chunk,
                       lambda s: F.struct(F.flatten(s["parts"]).alias("out"), s["state"].alias("state")))
    return done["out"], done["state"]


def matches(pattern: str, keep: Column | None = None, text: Column | str = "text") -> Column:
    """(start, end, match) of the text's matches; ``keep`` maps all matches to booleans, one each."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    flags = keep if keep is not None else F.transform(found, lambda x: F.lit(True))
    rows = F.arrays_zip(gaps.alias("gap"), found.alias("found"), flags.alias("keep"))
    empty = F.array().cast(SPANS)

    def step(at: Column, row: Column) -> tuple[Column, Column]:
        start = at + F.char_length(row["gap"])
        end = start + F.char_length(row["found"])
        span = F.struct(start.alias("start"), end.alias("end"), row["found"].alias("found"))
        return F.coalesce(end, start), F.when(row["keep"], F.array(span)).otherwise(empty)

    spans, _ = running(rows, F.lit(0), step, SPANS)
    return F.when(F.size(found) > 0, spans).otherwise(empty)


def outside(candidates: Column, base: Column) -> Column:
    """What of the candidates lies outside the ``base`` spans: both go by in order of their starts, once."""
    columns = lambda c, own: F.struct(c["start"].alias("start"), F.lit(own).alias("own"), c["end"].alias("end"),
                                      (c["found"] if own else F.lit(None).cast("string")).alias("found"))
    rows = F.array_sort(F.concat(F.transform(base, lambda b: columns(b, 0)), F.transform(candidates, lambda c: columns(c, 1))))

    def piece(state: Column, end: Column) -> Column:
        """The open candidate's text from where it is free up to ``end``."""
        size = end - state["free"]
        text = F.substring(state["found"], state["free"] - state["start"] + 1, size)
        span = F.struct(state["free"].alias("start"), end.alias("end"), text.alias("found"))
        return F.when(size >= WINDOW, F.array(span)).otherwise(F.array().cast(SPANS))

    def step(state: Column, row: Column) -> tuple[Column, Column]:
        own = row["own"] == 1
        covered = F.when(own, state["covered"]).otherwise(F.greatest(state["covered"], row["end"]))
        after = F.struct(
            covered.alias("covered"), F.when(own, row["start"]).otherwise(state["start"]).alias("start"),
            F.when(own, row["end"]).otherwise(state["end"]).alias("end"),
            F.when(own, F.greatest(row["start"], covered)).otherwise(F.greatest(state["free"], row["end"])).alias("free"),
            F.when(own, row["found"]).otherwise(state["found"]).alias("found"))
        return after, piece(state, F.when(own, state["end"]).otherwise(F.least(row["start"], state["end"])))

    zero = F.lit(0)
    first = F.struct(zero.alias("covered"), zero.alias("start"), zero.alias("end"), zero.alias("free"), F.lit("").cast("string").alias("found"))
    out, last = running(rows, first, step, SPANS)
    return F.concat(out, piece(last, last["end"]))


def hot_windows(found: Column, least: Column) -> Column:
    """(first, last): where the first window above ``least`` bits begins and the last one ends; null if none.

    ``found`` is a string over ALPHABET. The windows' counts change by one character in and one out.
    """
    gain = [0.0, *[n * math.log2(n) for n in range(1, WINDOW + 1)], 0.0]
    table = F.array(*[F.lit(g) for g in gain])
    places = F.transform(F.split(found, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    zero = F.array_repeat(F.lit(0), len(ALPHABET))

    def step(places: Column):
        def run(state: Column, i: Column) -> Column:
            new = F.element_at(places, i)
            old = F.when(i > WINDOW, F.element_at(places, F.greatest(i - WINDOW, F.lit(1)))).otherwise(0)
            had = F.when(old > 0, F.element_at(state["counts"], F.greatest(old, F.lit(1)))).otherwise(0)
            has = F.element_at(state["counts"], new) - (new == old).cast("int")
            total = (state["total"] - F.get(table, had) + F.get(table, F.greatest(had - 1, F.lit(0)))
                     - F.get(table, has) + F.get(table, has + 1))
            hot = (i >= WINDOW) & (F.lit(math.log2(WINDOW)) - total / WINDOW > least)
            return F.struct(
                F.transform(state["counts"], lambda c, k: c + (k + 1 == new).cast("int") - (k + 1 == old).cast("int")).alias("counts"),
                total.alias("total"),
                F.coalesce(state["first"], F.when(hot, i - WINDOW)).alias("first"),
                F.when(hot, i).otherwise(state["last"]).alias("last"))
        return run

    none = F.lit(None).cast("int")
    start = F.struct(zero.alias("counts"), F.lit(0.0).alias("total"), none.alias("first"), none.alias("last"))
    # The places are an element of a list of one, so that they are made once for a string.
    scanned = F.transform(F.array(places), lambda p: F.aggregate(
        F.sequence(F.lit(1), F.size(p)), start, step(p), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))))
    return F.get(scanned, F.lit(0))


def blanked(text: Column, pattern: str) -> Column:
    """The text with blanks in place of what matches, as long as before."""
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    parts = F.transform(rows, lambda r: F.concat(r["gap"], F.repeat(F.lit(" "), F.coalesce(F.char_length(r["found"]), F.lit(0)))))
    return F.when(text.rlike(pattern), F.array_join(parts, "")).otherwise(text)


def threshold(s: Column) -> Column:
    """Bits that a window of the segment ``s`` must exceed, by its class; null for numbers."""
    lower, upper, digit = s.rlike("[a-z]"), s.rlike("[A-Z]"), s.rlike("[0-9]")
    plain = s.rlike("^[A-Za-z0-9]+$")
    return (F.when(~lower & ~upper, F.lit(None).cast("double"))
            .when(digit & s.rlike("^[0-9A-Fa-f]+$"), THRESHOLD["hex"])
            .when(plain & digit & ~upper, THRESHOLD["lower"])
            .when(plain & digit & ~lower, THRESHOLD["upper"])
            .when(plain & ~(lower & upper), THRESHOLD["word"])
            .when(lower & upper & ~digit, THRESHOLD["letters"])
            .when(lower & upper & s.rlike("[A-Za-z][0-9]|[0-9][A-Za-z]"), THRESHOLD["mixed"])
            .otherwise(THRESHOLD["joined"]))


def entropy_spans(candidates: Column, base: Column, allow: tuple[str, ...]) -> Column:
    """(start, end) of the candidates' random segments outside the ``base`` spans and allow-listed parts."""
    def replaced(spans: Column, change) -> Column:
        return F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), change(c).alias("found")))

    def segments(c: Column) -> Column:
        own = matches(PART, text=c["found"])
        rest = F.flatten(F.transform(F.array(blanked(c["found"], PART)), lambda s: matches(CANDIDATE, text=s)))
        return F.transform(F.concat(own, rest), lambda s: F.struct((c["start"] + s["start"]).alias("start"), s["found"].alias("found")))

    left = outside(candidates, base)
    for pattern in allow:
        part = rf"(?<![A-Za-z0-9+])[A-Za-z0-9+]*(?:{pattern})[A-Za-z0-9+]*"
        left = replaced(left, lambda c, part=part: blanked(c["found"], part))
    scored = F.transform(F.flatten(F.transform(left, segments)), lambda c: F.struct(
        c["start"].alias("start"), hot_windows(c["found"], threshold(c["found"])).alias("hot")))
    hot = F.filter(scored, lambda c: c["hot"]["first"].isNotNull())
    return F.transform(hot, lambda c: F.struct(
        (c["start"] + c["hot"]["first"]).alias("start"), (c["start"] + c["hot"]["last"]).alias("end")))


def listed(spans: Column) -> Column:
    """kind:start:end, by start, then kind, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans.

    Positions are code points, the end exclusive. The base kinds are always reported; random-looking
    strings of at least WINDOW characters are added where they lie outside base spans and outside parts (between / _ = -)
    that match ``allow``. Null text counts as empty: no
    spans, and the hash of an empty list. Repeated rows are scanned each; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    found = docs.select(F.col("doc_id").cast("bigint"), text).select(
        "doc_id",
        matches(ASSIGN, F.transform(values, lambda v: F.char_length(v) >= LEAST_VALUE)).alias("assign"),
        matches(ACCESS).alias("access"),
        matches(HEX).alias("hex"),
        matches(CANDIDATE).alias("candidates"),
    )
    def kind(name: str) -> Column:
        return F.transform(name, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(name)).alias("kind"), s["end"].alias("end")))
    based = found.select("doc_id", "assign", "access", "hex", "candidates",
                         F.concat(kind("assign"), kind("access"), kind("hex")).alias("base"))
    spans = based.withColumn("entropy", entropy_spans(F.col("candidates"), F.col("base"), allow))
    count = lambda name: F.size(name).cast("bigint").alias(f"n_{name}")
    return spans.select(
        "doc_id", count("assign"), count("access"), count("hex"), count("entropy"),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("base", kind("entropy"))).alias("spans"))
