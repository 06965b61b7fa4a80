"""Size checks before a side is broadcast, and the salted join used beyond the bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def fits_broadcast(keys: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame of key columns is small enough to broadcast, by rows and by text bytes.

    Reads no further than ``rows`` rows.
    """
    text = [F.octet_length(c) for c, kind in keys.dtypes if kind == "string"]
    size = sum((F.coalesce(t, F.lit(0)) for t in text), F.lit(0)).cast("bigint")
    seen = keys.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).first()
    return seen.n <= rows and (seen.bytes or 0) <= BROADCAST_BYTES


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: Column) -> DataFrame:
    """Left join of a large table with skewed keys to a side with one row per key.

    Each side row is repeated once per salt and the large side is spread over the salts, so that
    a key holding most of the rows is shared by many tasks.
    """
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    return left.withColumn("_salt", salt).join(salted, [*keys, "_salt"], "left").drop("_salt")
