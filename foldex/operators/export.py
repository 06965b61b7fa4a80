"""Net changes between two states of an index, for systems outside Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.model import ApplyPolicy
from foldex.operators.barriers import Barrier, mark_cleared

NAMES = {"uid": "_id", "collection": "_collection", "database": "_database", "index_name": "index_name"}


def document_key(policy: ApplyPolicy) -> list[str]:
    """What identifies a document in its index: an id may repeat in another namespace of the index."""
    return list(dict.fromkeys(["index_name", *(NAMES[k] for k in policy.key_columns)]))


def _body(df: DataFrame, fields: dict[str, T.DataType], policy: ApplyPolicy) -> Column:
    """The document as JSON over the fields of both states; with kept nulls a field can be cleared."""
    def value(name: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(fields[name])
        if isinstance(fields[name], T.MapType):
            return F.map_from_entries(F.array_sort(F.map_entries(name)))
        return F.col(name)

    options = {"ignoreNullFields": "false"} if policy.nulls == "keep" else {}
    metadata = [c for c in ("_collection", "_database") if c in df.columns]
    return F.to_json(F.struct(*metadata, *[value(n).alias(n) for n in fields]), options)


def narrowed(df: DataFrame, keys: list[str], touched: DataFrame | None, cleared: Sequence[Barrier]) -> DataFrame:
    """The documents that changes can have altered: touched themselves (distinct keys), or in a namespace that was cleared."""
    if touched is None:
        return df
    # Joins that add nothing but a mark stay above what was computed of a row, so that texts behind a digest do not move.
    marked = df.join(touched.withColumn("_touched", F.lit(True)), keys, "left" if cleared else "inner")
    hits = marked.where("_touched").select(df.columns)
    if not cleared:
        return hits
    back = {v: k for k, v in NAMES.items()}
    rest = marked.where("_touched is null").select(df.columns).withColumnsRenamed(back).withColumn("_none", F.lit(None).cast("bigint"))
    marked = mark_cleared(rest.withColumn("_first", F.lit(-(2**63) + 1).cast("bigint")), list(cleared), "_first")
    gone = marked.where("_cleared").drop("_cleared", "_first", "_none").withColumnsRenamed(NAMES)
    return hits.unionByName(gone.select(hits.columns))


def actions(old: DataFrame, new: DataFrame, policy: ApplyPolicy | None = None, touched: DataFrame | None = None,
            cleared: Sequence[Barrier] = (), outlived: Sequence[Barrier] = (), digests: bool = False) -> DataFrame:
    """Action rows ``(index_name, database, collection, uid, action, body)`` that turn ``old`` into ``new``.

    One action per document that differs: index (new), update (changed) or delete. A document is
    identified as the policy says. With ``touched`` (document keys) and ``cleared`` (drops), only documents
    that these can have altered are compared; ``outlived`` are drops that documents of ``new`` may have outlived.
    With ``digests`` the body is only its digest, and no text is moved.
    """
    policy = policy or ApplyPolicy()
    keys = document_key(policy)
    side = [c for c in ("index_name", "_id", "_collection", "_database") if c in old.columns and c in new.columns]
    keys = [k for k in keys if k in side]
    fields = {f.name: f.dataType for df in (new, old) for f in df.schema.fields if f.name not in side}
    wanted = None if touched is None else touched.select(*keys).distinct()
    carried = [c for c in side if c not in keys]

    def read(df: DataFrame, name: str, cleared: Sequence[Barrier]) -> DataFrame:
        if digests:
            rows = narrowed(df.select(*side, F.md5(_body(df, fields, policy)).alias(name)), keys, wanted, cleared)
        else:
            rows = narrowed(df, keys, wanted, cleared)
            rows = rows.withColumn(name, _body(rows, fields, policy))
        return rows.select(*keys, *[F.col(c).alias(f"{name}{c}") for c in carried], name)

    both = read(old, "_old", cleared).join(read(new, "_new", outlived), keys, "full_outer")
    changed = F.col("_old") != F.col("_new")
    action = F.when(F.col("_old").isNull(), "index").when(F.col("_new").isNull(), "delete").when(changed, "update")
    names = {c: F.coalesce(f"_new{c}", f"_old{c}") if c in carried else F.col(c) for c in side}
    names["_id"] = names.pop("_id")
    out = {"_database": "database", "_collection": "collection", "_id": "uid", "index_name": "index_name"}
    return both.select(*[v.alias(out[c]) for c, v in names.items()], action.alias("action"), F.col("_new").alias("body")).where(
        F.col("action").isNotNull())


def write_actions(rows: DataFrame, path: str) -> None:
    """Action rows as JSON lines, one folder per index."""
    rows.write.mode("append").partitionBy("index_name").json(path)


def push(rows: DataFrame, send: Callable[[Iterator[dict]], None]) -> None:
    """Hands the action rows of each partition to a user client, which batches as it likes.

    There is one action per document, so partitions are independent; a retried task may send an
    action twice, which index, update and delete by key all tolerate.
    """
    rows.foreachPartition(lambda part: send(row.asDict() for row in part))
