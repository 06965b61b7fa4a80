"""Document states: what a fold must remember of a key so that earlier changes may still come.

A state holds the latest image of a key and the order numbers of its last insert, delete and image. States of one key merge by
taking the latest of each, in whatever order they come, so a late change has the effect it would have had in its turn.
Keys that are dead keep a state, as tombstones, until no change from below it is accepted any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.functions.sizing import BROADCAST_ROWS, fits_broadcast
from foldex.model import DELETE, INSERT, NAMESPACE, STATE_COLUMNS, ApplyPolicy, Router
from foldex.operators.barriers import Barrier, mark_cleared
from foldex.operators.fold import relevant
from foldex.operators.project import payload_columns

INSERT_AT, DELETE_AT, IMAGE_AT, ALIVE = STATE_COLUMNS
ORDERS = (INSERT_AT, DELETE_AT, IMAGE_AT)
#: Order numbers: large enough for ``seq`` and a number below it.
ORDER = T.DecimalType(38, 0)
STATE_FIELDS = [*[T.StructField(c, ORDER) for c in ORDERS], T.StructField(ALIVE, T.BooleanType())]


def check_policy(policy: ApplyPolicy, extended: bool) -> None:
    """Late changes need states that merge: not where an update's effect depends on every image before it."""
    if policy.update == "merge" and (policy.key == "index" or extended):
        raise ValueError("late changes cannot be folded where updates merge into shared keys or extended fields")


def order(seq: str | Column, nth: str | Column, step: int) -> Column:
    """``seq`` and ``nth`` as one number."""
    seq, nth = (F.col(c) if isinstance(c, str) else c for c in (seq, nth))
    return (seq.cast(ORDER) * F.lit(str(step)).cast("decimal(20,0)") + nth).cast(ORDER)


def states(events: DataFrame, policy: ApplyPolicy, route: Router) -> DataFrame:
    """One state per key that projected change rows touch; their ``seq`` is an order number."""
    rows = relevant(events.withColumn("index_name", route(F.col("database"), F.col("collection"))), policy)
    op, at = F.col("op"), F.col("seq").cast(ORDER)
    orders = {INSERT_AT: F.when(op == INSERT, at), DELETE_AT: F.when(op == DELETE, at), IMAGE_AT: F.when(op != DELETE, at)}
    return merged(rows.withColumns(orders), policy)


def merged(rows: DataFrame, policy: ApplyPolicy) -> DataFrame:
    """One state per key from several; combines on the map side, so a hot key is one row per task."""
    keys, payload = list(policy.key_columns), payload_columns(rows)
    of_key = ["index_name"] if policy.key == "namespace" else []  # a namespace has one index, with or without an image
    fields = [c for c in (*NAMESPACE, *payload) if c not in keys]
    totals = [F.max(c).alias(c) for c in (*of_key, *ORDERS)]
    if fields:
        totals.append(F.max_by(F.struct(*fields), IMAGE_AT).alias("_image"))
    found = rows.groupBy(*keys).agg(*totals)
    image = [F.col(f"_image.{c}").alias(c) for c in fields]
    return found.select(*keys, *of_key, *ORDERS, *image).select("uid", *NAMESPACE, "index_name", *payload, *ORDERS)


def combined(base: DataFrame | None, delta: DataFrame, policy: ApplyPolicy, touched: DataFrame,
             broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """States of a base with those of a delta merged in.

    ``touched`` are the rows whose keys the delta has, read to learn its size: if its keys can be broadcast, the base is not
    shuffled; else both meet in one aggregation on the key.
    """
    if base is None:
        return delta
    base = base.select(delta.columns)
    if not fits_broadcast(touched, broadcast_rows):
        return merged(base.unionByName(delta), policy)
    keys = list(policy.key_columns)
    names = F.broadcast(delta.select(*keys))
    met = merged(base.join(names, keys, "left_semi").select(delta.columns).unionByName(delta), policy)
    return base.join(names, keys, "left_anti").select(delta.columns).unionByName(met)


def settled(rows: DataFrame, drops: list[Barrier], policy: ApplyPolicy) -> DataFrame:
    """States with ``_alive``: whether the document exists after all deletes and drops.

    A dead key forgets its insert, and its fields unless a late insert may need them for a merging update.
    """
    merging = policy.update == "merge"
    start = F.col(INSERT_AT if merging else IMAGE_AT)
    marked = mark_cleared(rows.withColumn("_start", start), drops, "_start")
    alive = start.isNotNull() & (F.col(DELETE_AT).isNull() | (start > F.col(DELETE_AT))) & ~F.col("_cleared")
    marked = marked.withColumn(ALIVE, alive)
    out = {INSERT_AT: F.when(F.col(ALIVE), F.col(INSERT_AT))}
    if not merging:
        out |= {c: F.when(F.col(ALIVE), F.col(c)) for c in payload_columns(rows)}
    return marked.withColumns(out).select(*rows.columns, ALIVE)


def forgotten(rows: DataFrame, floor: int) -> DataFrame:
    """States without what no change at ``floor`` or above can bring back."""
    limit = F.lit(str(floor)).cast(ORDER)
    gone = ~F.col(ALIVE) & F.coalesce(F.col(IMAGE_AT) < limit, F.lit(False))
    last = F.greatest(*[F.col(c) for c in ORDERS])
    kept = rows.where(F.col(ALIVE) | F.coalesce(last >= limit, F.lit(False)))
    return kept.withColumns({c: F.when(~gone, F.col(c)) for c in (IMAGE_AT, *payload_columns(rows))})


def inserted(rows: DataFrame, at: int) -> DataFrame:
    """Index rows as states of documents that were all inserted at one moment."""
    moment, never = F.lit(str(at)).cast(ORDER), F.lit(None).cast(ORDER)
    return rows.withColumns({INSERT_AT: moment, DELETE_AT: never, IMAGE_AT: moment, ALIVE: F.lit(True)})

