"""Drop events as barriers: the first and the last ``seq`` at which a namespace was cleared."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldex.functions.sizing import BROADCAST_ROWS, salted_join
from foldex.model import CONTROL_OPS, DROP, DROP_DATABASE, ApplyPolicy, Router


@dataclass(frozen=True)
class Barrier:
    """Cleared keys with the seq of the last (``barrier``) and ``first`` clearing; without keys it covers every row.

    ``small`` says the rows were counted and are held as a local table.
    """

    keys: tuple[str, ...]
    rows: DataFrame
    small: bool


def scopes(policy: ApplyPolicy) -> list[tuple[str, tuple[str, ...]]]:
    """Which drop op clears rows by which key columns."""
    found = [(DROP, policy.drop_columns)]
    if policy.drop_database != "ignore":
        found.append((DROP_DATABASE, ("database",) if policy.drop_database == "database" else ()))
    return found


def drop_events(events: DataFrame, route: Router) -> DataFrame:
    """The drop events of a feed: a filter on ``op`` that reaches the scan."""
    drops = events.where(F.col("op").isin(*CONTROL_OPS))
    named = drops.withColumn("index_name", route(F.col("database"), F.col("collection")))
    return named.select("op", "index_name", "collection", "database", "seq")


def barriers(events: DataFrame, policy: ApplyPolicy, route: Router,
             broadcast_rows: int = BROADCAST_ROWS) -> list[Barrier]:
    """The barriers of a feed, from one pass over its drop events.

    The pass runs at once, to learn how many barriers there are: up to ``broadcast_rows`` they
    become local tables, beyond that they stay distributed.
    """
    wanted = scopes(policy)
    columns = ["index_name", "collection", "database"]
    used = {op: keys for op, keys in wanted}
    drops = drop_events(events, route).where(F.col("op").isin(*used))
    keyed = [
        F.when(F.col("op").isin([op for op, keys in wanted if c in keys]), F.col(c)).alias(c) for c in columns
    ]
    totals = drops.select("op", *keyed, "seq").groupBy("op", *columns).agg(
        F.max("seq").alias("barrier"), F.min("seq").alias("first"))
    found = totals.take(broadcast_rows + 1)
    spark = events.sparkSession
    result = []
    for op, keys in wanted:
        if len(found) > broadcast_rows:
            result.append(Barrier(keys, totals.where(F.col("op") == op).select(*keys, "barrier", "first"), False))
            continue
        rows = [tuple(r[k] for k in (*keys, "barrier", "first")) for r in found if r.op == op]
        if rows:
            result.append(Barrier(keys, spark.createDataFrame(rows, totals.select(*keys, "barrier", "first").schema), True))
    return result


def mark_cleared(rows: DataFrame, found: list[Barrier], seq: str) -> DataFrame:
    """Adds ``_cleared``: whether a barrier that covers the row lies at or above its ``seq``.

    ``rows`` should be folded already: clearing commutes with the fold, and folded rows are far
    fewer than events.
    """
    rows, limits = _with_limits(rows, found, "barrier")
    hit = [F.coalesce(F.col(seq) <= limit, F.lit(False)) for limit in limits]
    return rows.withColumn("_cleared", reduce(or_, hit, F.lit(False))).drop(*_helpers(found))


def uncleared_until(rows: DataFrame, found: list[Barrier], seq: str) -> DataFrame:
    """Keeps the rows whose namespace was not cleared before ``seq``."""
    rows, limits = _with_limits(rows, found, "first")
    hit = [F.coalesce(limit < F.col(seq), F.lit(False)) for limit in limits]
    return rows.where(~reduce(or_, hit, F.lit(False))).drop(*_helpers(found))


def _helpers(found: list[Barrier]) -> list[str]:
    return [f"_barrier_{i}" for i in range(len(found))]


def _with_limits(rows: DataFrame, found: list[Barrier], which: str) -> tuple[DataFrame, list[Column]]:
    """Adds each barrier's ``seq`` (``which``: barrier or first) to the rows it covers."""
    limits = []
    for name, barrier in zip(_helpers(found), found):
        if not barrier.keys:
            total = F.max if which == "barrier" else F.min
            limits.append(F.lit(barrier.rows.agg(total(which)).first()[0]).cast(barrier.rows.schema[which].dataType))
            continue
        keys = list(barrier.keys)
        side = barrier.rows.select(*keys, F.col(which).alias(name))
        if barrier.small:
            rows = rows.join(F.broadcast(side), keys, "left")
        else:
            rows = salted_join(rows, side, keys, F.col("uid"))
        limits.append(F.col(name))
    return rows, limits


def above_barriers(rows: DataFrame, found: list[Barrier], seq: str) -> DataFrame:
    """Keeps the rows no barrier covers."""
    return mark_cleared(rows, found, seq).where(~F.col("_cleared")).drop("_cleared")
