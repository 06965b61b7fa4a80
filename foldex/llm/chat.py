"""Chat formatting: conversations as one text each, its tokens, and a loss mask on them.

A turn is written as marker, role, marker, text, marker. The marker is a special token of the tokenizer, so no token
reaches over it; where a role or text holds what could be read as one, it is escaped, reversibly. A text is rendered
whole, encoded once with offsets, and the sorted spans of the assistant's texts meet the sorted spans of tokens by binary
search: a token bears loss if it lies in such a span.

Conversations come in ranges of their ids and turns, sorted, and stream through a task. A very long conversation is
spread over tasks; where it is cut, and where a rendering is cut because it has grown long, the cut lies between two
turns, so the tokens are those of the whole. Within one very long text a cut lies where the tokenizer starts a new word.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldex.llm.common import slices, written

#: Fixed value: the special token that stands between turns, roles and texts.
MARKER = "<|endoftext|>"
#: Characters of a rendering, and of a text that is encoded at once.
SEGMENT = 200_000
#: Bytes of a conversation's contents that a reader holds before it leaves the digest to a second pass.
HELD = 8 << 20

NEEDS_ESCAPE = re.compile(r"\\|<(?=\|)")
ESCAPED = re.compile(r"\\(\\|\|)")
#: Between a letter and a space with a letter behind it a word ends, whatever stands around.
WORD_END = re.compile(r"[A-Za-z](?= [A-Za-z])")

FORMATTED = "conv_id long, turn long, part long, n_turns long, formatted string, ids array<int>, starts array<int>, loss array<boolean>"
READ = ("conv_id long, turn long, part long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, turns binary, loss binary")


def escape(text: str) -> str:
    r"""``\`` is written twice and ``<|`` as ``<\|``, so no marker can stand in a text."""
    return NEEDS_ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else "<\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], learned: str) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns, and the spans of the texts to learn from, in order."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"{MARKER}{escape(role)}{MARKER}", escape(text)
        out += [head, body, MARKER]
        if role == learned and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(MARKER)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    parts = formatted.split(MARKER)
    return [(unescape(parts[i + 1]), unescape(parts[i + 2])) for i in range(0, len(parts) - 1, 3)]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text's tokens, and where they start and end."""
        ids, starts, ends, at = [], [], [], 0
        while at < len(text):
            end = len(text)
            if end - at > SEGMENT and (cut := WORD_END.search(text, at + SEGMENT)):
                end = cut.end()
            found = self.tokenizer.encode(text[at:end], add_special_tokens=False)
            offsets = np.array(found.offsets, np.int64).reshape(-1, 2) + at
            ids.append(np.array(found.ids, np.int32))
            starts.append(offsets[:, 0])
            ends.append(offsets[:, 1])
            at = end
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty.astype(np.int32), *ids]), np.concatenate([empty, *starts]), np.concatenate([empty, *ends])


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether each token lies in one of the spans; both are sorted, so a search finds the only span that can hold it."""
    if not spans:
        return np.zeros(len(starts), bool)
    first, last = np.array(spans).T
    at = np.searchsorted(first, starts, side="right") - 1
    return (at >= 0) & (ends <= last[at])


#: A worker's encoders, by tokenizer file.
LOADED: dict[str, Encoder] = {}


def formatted_row(encoder: Encoder, learned: str, conv: int | None, first: int | None, part: int, turns: list[tuple[str, str]]) -> tuple:
    text, spans = render(turns, learned)
    ids, starts, ends = encoder.encode(text)
    return conv, first, part, len(turns), text, ids, starts.astype(np.int32), loss_mask(starts, ends, spans)


def formatted_batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, turn, part, n, text, *tokens = zip(*rows)
    edges = pa.array(np.cumsum([0, *map(len, tokens[0])]), pa.int32())
    lists = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate(c), k)) for c, k in zip(tokens, (pa.int32(), pa.int32(), pa.bool_()))]
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in (conv, turn, part, n)], pa.array(text, pa.string()), *lists],
                                      ["conv_id", "turn", "part", "n_turns", "formatted", "ids", "starts", "loss"])


def format_rows(path: str, learned: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted turns as rendered, encoded and masked texts: one row per conversation, more for long ones."""
        if path not in LOADED:
            LOADED[path] = Encoder(path)
        encoder, number = LOADED[path], 0
        held: list[tuple[str, str]] = []
        done: list[tuple] = []
        of, first, size, waiting = None, None, 0, 0
        for batch in slices(batches, "text", SEGMENT):
            for conv, turn, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")]):
                if held and (conv != of or size > SEGMENT):
                    number += 1
                    done.append(formatted_row(encoder, learned, of, first, number, held))
                    waiting += size
                    held, size = [], 0
                if waiting > SEGMENT:
                    yield formatted_batch(done)
                    done, waiting = [], 0
                if not held:
                    of, first = conv, turn
                held.append((role, text))
                size += len(role) + len(text)
        if held:
            done.append(formatted_row(encoder, learned, of, first, number + 1, held))
        if done:
            yield formatted_batch(done)
    return run


def format_conversations(turns: DataFrame, tokenizer: str, learned: str = "assistant") -> DataFrame:
    """Rendered conversations: conv_id, turn (the first), part, n_turns, formatted, ids, starts and loss.

    ``turns`` has conv_id, turn, role and text; ``tokenizer`` is the path of a byte-level tokenizer with the marker as a
    special token, on every executor. ``ids`` are the tokens of ``formatted``, ``starts`` their first characters, and
    ``loss`` tells the tokens of texts of the role ``learned``. The rows of one conversation are next to each other,
    in order of turn and part; put together their texts and tokens are those of the whole conversation.

    Null text and role count as empty. Turns that share a number are ordered by role and text, repeated rows stay, a null turn
    is the first, and turns without conversation are one of their own. An empty table gives no rows.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), empty("role"), empty("text"))
    ordered = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(format_rows(tokenizer, learned), FORMATTED)


# --- reading back --------------------------------------------------------------------------------

def learned_text(formatted: str, starts: np.ndarray, loss: np.ndarray) -> str:
    """What lies under the mask, unescaped, read from the text and the tokens alone."""
    edges = np.flatnonzero(np.diff(loss.astype(np.int8), prepend=0, append=0)).tolist()
    at = np.append(starts, len(formatted)).tolist()
    return "".join(unescape(formatted[at[i]:at[k]]) for i, k in zip(edges[::2], edges[1::2]))


class Digest:
    """Digests of a conversation, and its contents while they are few."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, n_turns: int, turns: bytes, loss: bytes, loss_chars: int, chars: int) -> None:
        self.turns.update(turns)
        self.loss.update(loss)
        self.n_turns += n_turns
        self.loss_chars += loss_chars
        self.chars += chars

    def row(self, conv: int | None) -> tuple:
        return (conv, None, None, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, None, None)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in READ.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest for each conversation that lies whole in the task; the contents of the first and the last one, and of very long ones."""
    of, digest, parts, held, whole, begun = None, Digest(), [], 0, False, False
    out: list[tuple] = []
    waiting = 0
    for batch in slices(batches, "formatted", SEGMENT):
        starts, loss = batch.column("starts"), batch.column("loss")
        for i, row in enumerate(batch.select(["conv_id", "turn", "part", "n_turns", "formatted"]).to_pylist()):
            if begun and row["conv_id"] != of:
                out += [digest.row(of)] if whole else parts
                digest, parts, held, whole = Digest(), [], 0, True
            of, begun, text = row["conv_id"], True, row["formatted"]
            turns = "".join(f"{role}\n{said}\n" for role, said in parse(text)).encode()
            learned = learned_text(text, starts[i].values.to_numpy(), loss[i].values.to_numpy(zero_copy_only=False))
            contents = learned.encode()
            digest.add(row["n_turns"], turns, contents, len(learned), len(text))
            parts.append((of, row["turn"], row["part"], row["n_turns"], None, len(learned), None, len(text), turns, contents))
            held += len(turns)
            if not whole or held > HELD:
                out, waiting, parts, held, whole = out + parts, waiting + held, [], 0, False
            if waiting > HELD or len(out) > 5_000:
                yield batch_of(out)
                out, waiting = [], 0
    if out + parts:
        yield batch_of(out + parts)


def joined_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose contents come in order."""
    of, digest, begun = None, Digest(), False
    for batch in batches:
        for row in batch.to_pylist():
            if begun and row["conv_id"] != of:
                yield batch_of([digest.row(of)])
                digest = Digest()
            of, begun = row["conv_id"], True
            digest.add(row["n_turns"], row["turns"], row["loss"], row["loss_chars"], row["formatted_chars"])
    if begun:
        yield batch_of([digest.row(of)])


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from ``formatted`` as ``format_conversations`` gives it: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256 and formatted_chars.

    ``turns_sha256`` is the digest of role, line end, text and line end of every turn, ``loss_sha256`` that of the unescaped text under
    the mask. Conversations that two tasks share are put together by conversation; their contents stream through a digest.
    """
    read = written(formatted.mapInArrow(read_rows, READ), "chat")
    shared = read.where("turns is not null").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part")
    done = read.where("turns is null").unionByName(shared.mapInArrow(joined_rows, READ))
    return done.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def with_conversation(turns: DataFrame, conv_id: int, said: list[tuple[str, str]]) -> DataFrame:
    """``turns`` and a further conversation of (role, text)."""
    rows = [(conv_id, i, role, text) for i, (role, text) in enumerate(said)]
    own = turns.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    kept: list[Column] = [F.col(c).cast(kind) for c, kind in own.dtypes]
    return turns.select(kept).unionByName(own)
