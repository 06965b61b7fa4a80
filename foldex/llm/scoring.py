"""Language-model scores by deleted interpolation.

The model mixes the maximum-likelihood estimates of bigrams and unigrams and a uniform share for any word. The
weights depend on how often the context was seen, in buckets of powers of two, and are learned by
expectation-maximisation: a tenth of the documents is held out of the counts, and the weights are those that make
its counts likeliest.

Documents are dealt to chunks. A chunk asks once for each n-gram it holds and sends along how often it saw it; n-grams
are dealt to shards by hash, a shard adds up and answers each chunk with totals in the order of its
questions. So a very frequent n-gram costs a row per chunk, no count table is broadcast, and what travels is
sorted hashes, packed by their differences. N-grams are 64-bit hashes: two words share one with a chance of
about n * n / 2^65 among n distinct words.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldex.llm.common import row_key, utf8, written

CHUNK_BYTES = 10_000_000
FOLDS = 10
#: The fold that is scored but not learned from, and the one that the weights are learned from.
HELD_OUT, WEIGHTS_FOLD = 0, 9
BUCKETS = 48
#: Probabilities that only the weights are learned from are rounded to this part of a power of two.
STEPS = 8
NEVER = -2**15
ROUNDS = 50
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers as planes of bytes, without the planes that are 0 throughout."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + planes.T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :data[0]] = planes.T
    return out.view("<u8").ravel().astype(np.uint64)


# --- chunks ------------------------------------------------------------------------------------

class Words(dict):
    """Numbers for words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Chunk:
    """The tokens of a chunk's documents and its distinct n-grams in the order of their hashes.

    The end of a text is the empty word; it is also the context of a text's first word.
    """

    def __init__(self, table: pa.Table):
        words, ids, ids_of, folds = Words(), [], [], []
        words[b""] = 0
        for blob in table.column("blob").to_pylist():
            docs = pa.ipc.open_stream(io.BytesIO(blob)).read_all()
            ids_of += docs.column("doc_id").to_pylist()
            folds += docs.column("fold").to_pylist()
            for column in docs.column("text").chunks:
                for text in utf8(column):
                    tokens = (text or b"").lower().split()
                    tokens.append(b"")
                    ids.append(np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)))
        self.doc_ids, self.folds = ids_of, np.array(folds)
        self.lengths = np.array([len(x) for x in ids])
        self.starts = np.cumsum(self.lengths) - self.lengths
        hashes = mix(np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64))
        self.words, rank = np.unique(hashes, return_inverse=True)
        self.token = rank[np.concatenate(ids)]
        self.context = np.roll(self.token, 1)
        self.context[self.starts] = rank[0]
        pairs = mix(self.words[self.context] * U(0x9E3779B97F4A7C15) + self.words[self.token])
        self.pairs, self.pair = np.unique(pairs, return_inverse=True)

    def per_token(self, values: np.ndarray) -> np.ndarray:
        return np.repeat(values, self.lengths)


def fold() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(-1)).cast("int")


def blobs(docs: DataFrame, chunks: int) -> DataFrame:
    """(chunk, blob): the documents, compressed; those the weights are learned from have chunks of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            names, starts = np.unique(chunk[order], return_index=True)
            out = []
            for at in np.split(order, starts[1:]) if len(order) else []:
                sink = io.BytesIO()
                part = batch.select(["doc_id", "fold", "text"]).take(pa.array(at))
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
                    to.write_batch(part)
                out.append(sink.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(out, pa.binary())], ["chunk", "blob"])

    own = F.when(F.col("fold") == WEIGHTS_FOLD, chunks).otherwise(0)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").withColumn("fold", fold()).withColumn(
        "chunk", (F.pmod(row_key("doc_id", "text"), F.lit(chunks)) + own).cast("int"))
    return rows.mapInArrow(run, "chunk int, blob binary")


# --- counts ------------------------------------------------------------------------------------

def asked(bits: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """For each shard and kind (0: words, 1: pairs) the chunk's n-grams and how often its training documents have them."""
        chunk = Chunk(table)
        learned = chunk.per_token(chunk.folds != HELD_OUT).astype(np.float64)
        rows = []
        for kind, (keys, at) in enumerate(((chunk.words, chunk.token), (chunk.pairs, chunk.pair))):
            counts = np.bincount(at, learned, len(keys)).astype(np.uint64)
            edges = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << U(64 - bits))
            for shard, (start, end) in enumerate(zip(edges, [*edges[1:], len(keys)])):
                if end > start:
                    rows.append((shard, kind, packed(np.diff(keys[start:end], prepend=keys[start])), keys[start:start + 1].tobytes(), packed(counts[start:end])))
        shard, kind, steps, first, counts = map(list, zip(*rows))
        return pa.table({
            "shard": pa.array(shard, pa.int32()), "kind": pa.array(kind, pa.int32()),
            "chunk": pa.array([table.column("chunk")[0].as_py()] * len(rows), pa.int32()),
            "first": pa.array(first, pa.binary()), "steps": pa.array(steps, pa.binary()), "counts": pa.array(counts, pa.binary())})
    return run


def answered(chunks: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Totals for every question of a shard, and in a row of chunk -1 the shard's words, tokens and tokens held out of the counts."""
        shard, rows = table.column("shard")[0].as_py(), []
        for kind in (0, 1):
            some = table.filter(pa.compute.equal(table.column("kind"), kind)).select(["chunk", "first", "steps", "counts"]).to_pylist()
            if not some:
                continue
            keys = [np.cumsum(unpacked(r["steps"]), dtype=np.uint64) + np.frombuffer(r["first"], np.uint64) for r in some]
            counts = [unpacked(r["counts"]).astype(np.float64) for r in some]
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.uint64)
            aside = [c if r["chunk"] >= chunks else np.zeros(len(c)) for r, c in zip(some, counts)]
            without = np.bincount(at, np.concatenate(aside), len(distinct)).astype(np.uint64)
            start = 0
            for r, own in zip(some, keys):
                here = at[start:start + len(own)]
                start += len(own)
                rows.append((r["chunk"], shard, kind, packed(total[here]), packed(without[here]), None, None, None))
            if kind == 0:
                rows.append((-1, shard, kind, None, None, int((total > 0).sum()), int(total.sum()), int(without.sum())))
        return pa.Table.from_pylist([dict(zip(ANSWERS.names, r)) for r in rows], schema=ANSWERS)
    return run


ANSWERS = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("kind", pa.int32()), ("total", pa.binary()),
                     ("aside", pa.binary()), ("words", pa.int64()), ("tokens", pa.int64()), ("aside_tokens", pa.int64())])


def totals(answers: pa.Table, kind: int, column: str) -> np.ndarray:
    """The answers to a chunk's questions in their order."""
    rows = answers.filter(pa.compute.equal(answers.column("kind"), kind)).sort_by("shard")
    return np.concatenate([unpacked(x) for x in rows.column(column).to_pylist()]).astype(np.float64)


# --- model -------------------------------------------------------------------------------------

def bucket(context: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, then one for each power of two."""
    return np.minimum(np.frexp(context)[1], BUCKETS - 1)


def divided(a: np.ndarray, b: np.ndarray | float) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.broadcast_to(np.asarray(b) > 0, a.shape))


def rounded(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(np.log2(np.where(p > 0, p, 1.0)) * STEPS), NEVER).astype(np.int64)


def events(tokens: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """How often held-out tokens meet each context bucket and rounded estimates from the other counts."""
        chunk = Chunk(docs)
        words = totals(answers, 0, "total") - totals(answers, 0, "aside")
        pairs = totals(answers, 1, "total") - totals(answers, 1, "aside")
        context = words[chunk.context]
        rows = np.stack([bucket(context), rounded(divided(pairs[chunk.pair], context)), rounded(divided(words[chunk.token], tokens))])
        found, n = np.unique(rows, axis=1, return_counts=True)
        return pa.table({"bucket": pa.array(found[0], pa.int32()), "pair": pa.array(found[1], pa.int32()),
                         "word": pa.array(found[2], pa.int32()), "n": pa.array(n, pa.int64())})
    return run


def learned_weights(rows: pa.Table, uniform: float) -> np.ndarray:
    """Weights of pair, word and uniform estimates per bucket (BUCKETS x 3), by expectation-maximisation.

    One count is added for each estimate, so a bucket without events weighs them alike. Contexts
    never seen have no pair estimate.
    """
    b, pair, word = (rows.column(c).to_numpy().astype(np.int64) for c in ("bucket", "pair", "word"))
    n = rows.column("n").to_numpy().astype(np.float64)
    power = lambda x: np.where(x == NEVER, 0.0, 2.0 ** (np.where(x == NEVER, 0, x) / STEPS))
    p = np.stack([power(pair), power(word), np.full(len(b), uniform)])
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(ROUNDS):
        joint = p * weights[b].T
        joint *= n / joint.sum(axis=0)
        sums = np.stack([np.bincount(b, j, BUCKETS) for j in joint], axis=1) + 1
        sums[0, 0] = 0
        weights = sums / sums.sum(axis=1, keepdims=True)
    return weights


def scored(weights: np.ndarray, vocabulary: int, tokens: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return SCORES.empty_table()
        chunk = Chunk(docs)
        words, pairs = totals(answers, 0, "total"), totals(answers, 1, "total")
        context, word = words[chunk.context], words[chunk.token]
        w = weights[bucket(context)]
        p = w[:, 0] * divided(pairs[chunk.pair], context) + w[:, 1] * divided(word, float(tokens)) + w[:, 2] / (vocabulary + 1)
        base = np.log10((word + 0.1) / (tokens + 0.1 * (vocabulary + 1)))
        add = lambda x: np.add.reduceat(x, chunk.starts)
        return pa.table([
            pa.array(chunk.doc_ids, pa.int64()), pa.array(chunk.folds == HELD_OUT), pa.array(chunk.lengths, pa.int64()),
            pa.array(add((word > 0).astype(np.int64)), pa.int64()), pa.array([tokens] * len(chunk.lengths), pa.int64()),
            pa.array(add(base)), pa.array(add(np.log10(p)))], schema=SCORES)
    return run


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def score_texts(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null text is empty: its end alone is scored. A document without doc_id is not held out. Repeated rows are
    learned from and scored each. ``base_score`` is of single words with a tenth added to each count; ``score`` is
    the model's log10 probability of the whole text. An empty table gives no rows.
    """
    size = docs.agg(F.sum(F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))))).first()[0] or 0
    chunks = max(8, math.ceil(size / CHUNK_BYTES))
    bits = max(6, (2 * chunks).bit_length())
    questions = blobs(docs, chunks).groupBy("chunk").applyInArrow(
        asked(bits), "shard int, kind int, chunk int, first binary, steps binary, counts binary")
    answers = written(questions.groupBy("shard").applyInArrow(answered(chunks), (
        "chunk int, shard int, kind int, total binary, aside binary, words long, tokens long, aside_tokens long")), "counts")
    sums = answers.where("chunk = -1").agg(F.sum("words"), F.sum("tokens"), F.sum("aside_tokens")).first()
    vocabulary, tokens, aside = (x or 0 for x in sums)

    answers = answers.select("chunk", "shard", "kind", "total", "aside")
    held = blobs(docs.where(fold() == WEIGHTS_FOLD), chunks).groupBy("chunk").cogroup(
        answers.where(F.col("chunk") >= chunks).groupBy("chunk"))
    # At most one row per bucket and pair of rounded probabilities.
    rows = held.applyInArrow(events(tokens - aside), "bucket int, pair int, word int, n long").groupBy(
        "bucket", "pair", "word").agg(F.sum("n").alias("n")).toArrow()
    weights = learned_weights(rows, 1 / (vocabulary + 1))

    replies = answers.where("chunk >= 0").drop("aside")
    return blobs(docs, chunks).groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(scored(weights, vocabulary, tokens), (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
