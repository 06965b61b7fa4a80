"""Ordered lookups per key that stay parallel when one key holds most of the rows.

Rows are cut into ranges of their order, so a hot key is shared by as many tasks as there are
ranges. What earlier ranges contribute is carried by one summary row per key and range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS = 100_000


@dataclass(frozen=True)
class Ranges:
    """Equal ranges of the order between its smallest and largest value.

    A sequence that counts events fills them evenly, whichever keys the events belong to. Other
    orders only lose balance: any ranges give the same results.
    """

    low: float
    high: float
    count: int

    def of(self, order: str) -> Column:
        return F.width_bucket(F.col(order).cast("double"), F.lit(self.low), F.lit(self.high), F.lit(self.count).cast("bigint"))


def order_ranges(df: DataFrame, order: str, rows_per_range: int = ROWS) -> Ranges:
    """Ranges over all rows of ``df``, so many that one has about ``rows_per_range`` rows; reads one column."""
    low, high, n = df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    low, high = float(low or 0), float(high or 0)
    return Ranges(low, high + max(1.0, abs(high) * 1e-9), max(1, n // rows_per_range))


def _within(keys: list[str], order: str) -> W:
    return W.partitionBy(*keys, "_bucket").orderBy(order).rangeBetween(W.unboundedPreceding, -1)


def running_max(df: DataFrame, keys: list[str], order: str, values: dict[str, Column],
                ranges: Ranges) -> DataFrame:
    """For each row the maximum of every value over rows of the same key with a smaller order."""
    inputs = {f"_in_{n}": c for n, c in values.items()}
    rows = df.withColumns({**inputs, "_bucket": ranges.of(order)})
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*keys, "_bucket")
        .agg(*[F.max(f"_in_{n}").alias(f"_sum_{n}") for n in values])
        .select(*keys, "_bucket", *[F.max(f"_sum_{n}").over(before).alias(f"_carry_{n}") for n in values])
    )
    local = rows.withColumns({f"_run_{n}": F.max(f"_in_{n}").over(_within(keys, order)) for n in values})
    joined = local.join(carried, [*keys, "_bucket"])
    result = {n: F.greatest(f"_run_{n}", f"_carry_{n}") for n in values}
    helpers = ["_bucket"] + [p + n for n in values for p in ("_in_", "_run_", "_carry_")]
    return joined.withColumns(result).drop(*helpers)


def last_before(df: DataFrame, marks: DataFrame, keys: list[str], order: str, name: str,
                ranges: Ranges) -> DataFrame:
    """For each row of ``df`` the order of the last mark of its key before it, as column ``name``.

    ``marks`` (``keys`` and ``order``) should have few distinct keys: their summary is filled up
    to one row per key and range, which spares a second pass over ``df``.
    """
    bucketed = marks.withColumn("_bucket", ranges.of(order))
    by_range = W.partitionBy(*keys).orderBy("_bucket")
    filled = (
        bucketed.groupBy(*keys, "_bucket").agg(F.max(order).alias("_carry"))
        .withColumn("_next", F.coalesce(F.lead("_bucket").over(by_range), F.lit(ranges.count + 1).cast("bigint")))
        .where(F.col("_bucket") < F.col("_next"))
        .select(*keys, "_carry", F.explode(F.sequence(F.col("_bucket") + 1, F.col("_next"))).alias("_bucket"))
    )
    probes = df.withColumn("_bucket", ranges.of(order)).withColumn("_probe", F.lit(True))
    both = probes.unionByName(bucketed.select(*keys, order, "_bucket"), allowMissingColumns=True)
    mark = F.when(F.col("_probe").isNull(), F.col(order))
    local = both.withColumn("_run", F.max(mark).over(_within(keys, order))).where(F.col("_probe"))
    joined = local.join(filled, [*keys, "_bucket"], "left")
    return joined.withColumn(name, F.greatest("_run", "_carry")).drop("_bucket", "_probe", "_run", "_carry")
