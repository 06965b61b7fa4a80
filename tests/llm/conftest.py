import pytest
from pyspark.sql import functions as F

CLASHING = ("row", "doc", "size", "key", "hash", "n", "n_lines", "group", "kept", "taken", "score", "lang_pred", "component",
            "band", "gone", "chunk", "fold", "part", "run", "target", "length", "piece", "spans", "html", "vec_id")


@pytest.fixture
def documents(spark):
    """Builds a documents table; ``clash`` adds columns named like the operators' own."""
    def make(rows, clash=False):
        full = [(i, text, *(more or ("en", "a"))) for i, text, *more in rows]
        full = [(i, t, *rest) if len(rest) == 2 else (i, t, *rest[0]) for i, t, *rest in full]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string").withColumn(
            "n_chars", F.char_length("text").cast("bigint"))
        return df.withColumns({c: F.lit(7) for c in CLASHING}) if clash else df
    return make


@pytest.fixture
def hard_texts():
    """Null, empty, blank, very long, repeated and tied texts, with null ids."""
    long = " ".join(f"word{i % 7919}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, long), (6, "the same short text of six words"), (6, "the same short text of six words"),
            (7, "THE same\nshort text of six words"), (None, "the same short text of six words"), (None, None), (8, "éß漢字 — ünï"), (9, "\x0b\x0c x \r\n")]
