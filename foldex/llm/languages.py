"""Language identification of texts that may mix languages.

Character trigrams of labelled documents give each language a distribution over hashed features; all
labelled documents are counted, in Spark, and the counts are added up. A document's language proportions
are the weights of a mixture of these distributions, estimated by expectation-maximisation. Which
languages the document has is chosen by penalised likelihood: beginning with the likeliest one, the
next language by weight is added while the likelihood grows by more than the penalty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.llm.common import written

BITS = 15
FEATURES = 1 << BITS
SMOOTHING = 0.5
ROUNDS = 10
#: Log-likelihood, per natural logarithm of the document's features, that a further language must bring.
PENALTY = 4.0
#: The model that is sent to tasks has FEATURES numbers for each of at most so many languages: 512 MB.
MAX_LANGUAGES = 2048
UNKNOWN = "und"
#: A text that no language explains is so many standard deviations of labelled texts less likely than they are.
DEVIATIONS = 12.0


@cache
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The text's features and their counts; none without letters.

    Trigrams run over lower-cased letters, with one mark for whatever stands between words.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    word = letters()[codes]
    if not word.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keep = word.copy()
    keep[1:] |= word[:-1]
    x = np.concatenate([[np.uint32(0)], np.where(word, codes, np.uint32(0))[keep], [np.uint32(0)]]).astype(np.uint32)
    h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
    h = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)
    count = np.bincount(h, minlength=FEATURES)
    found = np.flatnonzero(count)
    return found, count[found]


def held_out() -> Column:
    """Documents that are not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature counts per language of the partition's documents."""
    total: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, count in total.items():
            found = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()), pa.array(count[found], pa.int64())],
                ["lang", "feature", "n"])
        total.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            found, n = trigrams(text)
            if lang not in total and len(total) >= 64:
                yield from rows()
            total.setdefault(lang, np.zeros(FEATURES, np.int64))[found] += n
    yield from rows()


def language_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages by name, and each one's probabilities of the features."""
    labelled = docs.where(~held_out() & F.col("lang").isNotNull()).select("lang", "text")
    counts = labelled.mapInArrow(counted, "lang string, feature int, n long").groupBy("lang", "feature").agg(
        F.sum("n").alias("n"))
    counts = written(counts, "language-counts")
    names = [r.lang for r in counts.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the model is too large to send to tasks")
    model = np.full((len(names), FEATURES), SMOOTHING)
    at = {lang: i for i, lang in enumerate(names)}
    # At most one row per language and feature.
    rows = counts.toArrow()
    lang = np.array([at[x] for x in rows.column("lang").to_pylist()], np.int64)
    model[lang, rows.column("feature").to_numpy()] += rows.column("n").to_numpy()
    return names, (model / model.sum(axis=1, keepdims=True)).astype(np.float32)


def mixtures(p: np.ndarray, n: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixture weights (languages x documents) after ROUNDS of expectation-maximisation, and log-likelihoods.

    ``p``: probabilities (languages x features of all documents, one document after another from ``starts``
    on), ``n``: counts, ``weights``: where to begin; a language that begins with 0 stays out.
    """
    sizes = np.diff(np.append(starts, len(n)))
    total = np.add.reduceat(n, starts)
    for _ in range(ROUNDS):
        joint = p * np.repeat(weights, sizes, axis=1)
        joint *= n / joint.sum(axis=0)
        weights = np.add.reduceat(joint, starts, axis=1) / total
    mixed = (p * np.repeat(weights, sizes, axis=1)).sum(axis=0)
    return weights, np.add.reduceat(n * np.log(mixed), starts)


def chosen(model: np.ndarray, documents: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[list[tuple[int, float]]], np.ndarray]:
    """Per document its languages with their proportions, the largest first; and the log-likelihood of all of them together."""
    n = np.concatenate([c for _, c in documents]).astype(np.float32)
    starts = np.cumsum([0, *[len(f) for f, _ in documents[:-1]]])
    p = model[:, np.concatenate([f for f, _ in documents])]
    weights, _ = mixtures(p, n, starts, np.full((len(model), len(documents)), 1 / len(model), np.float32))
    order = np.argsort(-weights, axis=0, kind="stable")
    alone = np.add.reduceat(n * np.log(p), starts, axis=1)
    best = alone.argmax(axis=0)
    out = [[(int(b), 1.0)] for b in best]
    score, open_docs = alone.max(axis=0), np.arange(len(documents))
    likelihood = score.copy()
    for k in range(2, len(model) + 1):
        # The documents that took the last language try the next one.
        parts = [np.arange(starts[d], starts[d] + len(documents[d][0])) for d in open_docs]
        at = np.concatenate(parts)
        own = np.cumsum([0, *[len(x) for x in parts[:-1]]])
        top = order[:k, open_docs]
        some = np.stack([p[np.repeat(top[i], [len(x) for x in parts]), at] for i in range(k)])
        w, fit = mixtures(some, n[at], own, np.full((k, len(open_docs)), 1 / k, np.float32))
        cost = PENALTY * (k - 1) * np.log(np.add.reduceat(n[at], own) + 1)
        better = fit - cost > score[open_docs]
        for j in np.flatnonzero(better):
            d = open_docs[j]
            score[d], likelihood[d] = fit[j] - cost[j], fit[j]
            out[d] = sorted(((int(top[i, j]), float(w[i, j])) for i in range(k)), key=lambda x: (-x[1], x[0]))
        open_docs = open_docs[better]
        if not len(open_docs):
            break
    return out, likelihood


def identified(names: list[str], model: np.ndarray, fit: bool = False) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Predictions; the text is left out, other columns stay. ``fit`` adds the number of features and the log-likelihood of one."""
        for batch in batches:
            langs: list[list[str]] = []
            shares: list[list[float]] = []
            features: list[int] = []
            fits: list[float | None] = []

            def flush(some: list[tuple[np.ndarray, np.ndarray]]) -> None:
                known = [d for d in some if len(d[0])] if names else []
                found = zip(*chosen(model, known)) if known else iter(())
                for d in some:
                    mix, likelihood = next(found) if names and len(d[0]) else ([], None)
                    n = int(d[1].sum())
                    features.append(n)
                    fits.append(None if likelihood is None else float(likelihood) / n)
                    langs.append([names[i] for i, _ in mix])
                    shares.append([min(1.0, w) for _, w in mix])

            held, cells = [], 0
            for text in batch.column("text").to_pylist():
                held.append(trigrams(text))
                cells += len(held[-1][0])
                if cells * max(1, len(names)) > 1_000_000:
                    flush(held)
                    held, cells = [], 0
            flush(held)
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in rest],
                pa.array([x[0] if x else UNKNOWN for x in langs], pa.string()),
                pa.array([x[0] if x else 0.0 for x in shares], pa.float64()),
                pa.array(langs, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64())),
                *([pa.array(features, pa.int64()), pa.array(fits, pa.float64())] if fit else []),
            ], [*rest, "lang_pred", "score", "langs", "shares", *(["features", "fit"] if fit else [])])
    return run


def predict_languages(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, and all its languages with their shares.

    Learned from ``text`` and ``lang`` of documents that are not held out and have a ``lang``; a null
    doc_id is not held out. ``score`` is the share of the predicted language. Texts that are null or have no
    letter are ``und`` with score 0, as all are if nothing could be learned. Every row is predicted, repeated rows too, and
    whole texts however long; equal texts get equal results but for rounding. Of languages that are equally likely the first by name is taken. An empty table gives no rows.
    """
    names, model = language_model(docs)
    rows = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    kinds = "doc_id long, held_out boolean, lang_pred string, score double, langs array<string>, shares array<double>"
    return rows.mapInArrow(identified(names, model), kinds)


def in_known_language(docs: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """The documents that their languages, one or many, explain; all documents if no language could be learned.

    Texts without letters go, and those whose log-likelihood per feature, under the mixture of all their languages, lies more
    than ``deviations`` standard deviations below the mean of the labelled texts. The variance is that of labelled
    texts, and that of single features over the text's number of features, so short texts are judged with care.
    Repeated rows are judged alike; texts are judged whole; all columns stay. An empty table stays empty.
    """
    names, model = language_model(docs)
    if not names:
        return docs
    mean = (model * np.log(model)).sum(axis=1)
    single = float(((model * np.log(model) ** 2).sum(axis=1) - mean ** 2).max())
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(doc, "text")
    kinds = rows.select("doc").schema.add("lang_pred", "string").add("score", "double")
    for name, of in (("langs", T.StringType()), ("shares", T.DoubleType())):
        kinds = kinds.add(name, T.ArrayType(of))
    kinds = kinds.add("features", "long").add("fit", "double")
    labels = docs.where(F.col("lang").isNotNull()).select("text").mapInArrow(
        identified(names, model, fit=True), T.StructType(kinds.fields[1:]))
    usual = labels.agg(F.avg("fit").alias("mean"), F.var_pop("fit").alias("var")).first()
    found = rows.mapInArrow(identified(names, model, fit=True), kinds)
    if usual["mean"] is None:
        return docs
    least = usual["mean"] - deviations * F.sqrt(usual["var"] + single / F.col("features"))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("fit") >= least)).select("doc.*")
