"""What the operators of this subpackage share: written tables, row ids, tokens and partition counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldex.session import scratch

#: The white space that separates words: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once to the shared folder and read back, so that its lineage ends there."""
    path = scratch(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(*columns: str) -> Column:
    """A number for a row's content: equal rows share it, and every scan gives the same."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session is set up."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes, undecoded."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a piece holds about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n or 0
        if start < len(sizes):
            yield batch.slice(start)


def words_in(texts: list[bytes], table: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, and for each the number of line ends before it.

    ``table`` maps every byte to a byte of a word, a space or a line end; a line end is put between texts. Arrays do
    the work, so the cost per word is that of its bytes.
    """
    data = np.frombuffer(b"\n".join(texts).translate(table), np.uint8)
    word = (data != 10) & (data != 32)
    start = word.copy()
    start[1:] &= ~word[:-1]
    at = np.flatnonzero(start)
    inside = np.cumsum(word, dtype=np.int32)
    edges = np.append(inside[at] - 1, inside[-1] if len(inside) else 0).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data[word]))])
    return words, np.cumsum(data == 10, dtype=np.int32)[at]


def byte_table(words: bytes, breaks: bytes = b"") -> bytes:
    """A table for ``words_in``: these bytes make words (A to Z in lower case), ``breaks`` and U+000A end lines, all others are spaces."""
    return bytes(10 if b == 10 or b in breaks else bytes([b]).lower()[0] if b in words else 32 for b in range(256))
