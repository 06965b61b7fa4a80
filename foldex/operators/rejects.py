"""Changes that cannot be applied: which, and why. Everything else goes on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.functions.extended_json import plain_json
from foldex.functions.running import last_before, order_ranges, running_max
from foldex.functions.variants import mismatch
from foldex.model import (
    CHANGE_COLUMNS,
    CONTROL_OPS,
    DELETE,
    DOCUMENT_OPS,
    DROP_DATABASE,
    INSERT,
    NAMESPACE,
    OPS,
    UPDATE,
    ApplyPolicy,
    IndexConfig,
    Router,
    by_collection,
)
from foldex.operators.barriers import drop_events, scopes
from foldex.operators.fold import cleared_since_image

# Fixed value: a document key is the text form of a 12-byte object id.
OBJECT_ID = "^[0-9a-f]{24}$"


def row_reason(as_of: int | None = None, key_pattern: str | None = None) -> Column:
    """Why a single change row is unusable, or null; needs no other row."""
    op, uid = F.col("op"), F.col("uid")
    document = op.isin(*DOCUMENT_OPS)
    reason = F.when(F.col("seq").isNull(), "missing_seq")
    reason = reason.when(op.isNull() | ~op.isin(*OPS), "unknown_op")
    reason = reason.when(F.col("database").isNull(), "missing_namespace")
    reason = reason.when((op != DROP_DATABASE) & F.col("collection").isNull(), "missing_namespace")
    reason = reason.when(document & (uid.isNull() | (uid == "")), "missing_key")
    if key_pattern:
        reason = reason.when(document & ~uid.rlike(key_pattern), "malformed_key")
    if as_of is not None:
        reason = reason.when(F.col("seq") <= as_of, "late")
    return reason


def accepted(events: DataFrame, as_of: int | None = None, key_pattern: str | None = None) -> DataFrame:
    """The change rows that can be applied."""
    return events.where(row_reason(as_of, key_pattern).isNull())


def rejected(events: DataFrame, as_of: int | None = None, key_pattern: str | None = None) -> DataFrame:
    """The change rows that cannot, with a ``reason``."""
    reason = row_reason(as_of, key_pattern)
    return events.select(*CHANGE_COLUMNS, reason.alias("reason")).where(F.col("reason").isNotNull())


def _mismatch(config: IndexConfig, variant: Column) -> Column:
    """Whether a rule of the row's collection would have to convert a value of the parsed document, in whatever arrays."""
    found = F.lit(False)
    for collection, rules in config.rules.items():
        for rule in rules:
            if rule.mapper.custom is not None or isinstance(rule.mapper.data_type, T.NullType):
                continue
            hit = F.coalesce(mismatch(variant, rule.field, rule.mapper.data_type, rule.mapper.multi), F.lit(False))
            found = found | ((F.col("collection") == collection) & hit)
    return found


def document_reason(changes: DataFrame, config: IndexConfig, doc: str = "doc", strict: bool | None = None) -> Column:
    """Why a change's JSON document cannot be used, or null; documents that are structs have no faults.

    Strict typing (the configuration's by default) also refuses values that a rule would convert or not take,
    through embedded documents and arrays of documents at any depth. A drop is known by its namespace: whatever
    it carries as a document is not looked at.
    """
    data_type = changes.schema[doc].dataType
    if not isinstance(data_type, T.StringType | T.VariantType):
        return F.lit(None).cast("string")
    variant = F.try_parse_json(plain_json(F.col(doc))) if isinstance(data_type, T.StringType) else F.col(doc)
    unreadable = F.col(doc).isNotNull() & F.try_variant_get(variant, "$", "map<string, variant>").isNull()
    reason = F.when(unreadable, "unreadable_document")
    if config.strict_types if strict is None else strict:
        reason = reason.when(_mismatch(config, variant), "type_mismatch")
    return F.when(~F.coalesce(F.col("op").isin(*CONTROL_OPS), F.lit(False)), reason)


def type_mismatches(events: DataFrame, config: IndexConfig, doc: str = "doc") -> DataFrame:
    """Strict typing for JSON documents: the rows that a strict store would reject for their document."""
    reason = document_reason(events, config, doc, strict=True)
    return events.select(*CHANGE_COLUMNS, reason.alias("reason")).where(F.col("reason").isNotNull())


def sequence_conflicts(events: DataFrame) -> DataFrame:
    """Sequence numbers carried by different events; the same event delivered twice is fine."""
    content = [c for c in events.columns if c not in ("seq", "batch")]
    identity = F.xxhash64(F.to_json(F.struct(*content)))
    return (
        events.groupBy("seq")
        .agg(F.min(identity).alias("_low"), F.max(identity).alias("_high"))
        .where(F.col("_low") != F.col("_high"))
        .select("seq", F.lit("duplicate_seq").alias("reason"))
    )


def updates_without_target(events: DataFrame, policy: ApplyPolicy, route: Router = by_collection,
                           base: DataFrame | None = None) -> DataFrame:
    """Merging updates that found no document when they arrived.

    The document existed if the key's last insert before the update lies above its last delete
    and above the last drop of its namespace (of the namespace that held it, where keys are shared).
    """
    rows = events.select(*CHANGE_COLUMNS)
    if base is not None:
        seeds = base.select("seq", F.lit(INSERT).alias("op"), *NAMESPACE, "uid")
        rows = rows.unionByName(seeds)
    rows = rows.withColumn("index_name", route(F.col("database"), F.col("collection")))
    op, seq, keys = F.col("op"), F.col("seq"), list(policy.key_columns)
    documents, drops = rows.where(op.isin(*DOCUMENT_OPS)), drop_events(events, route)
    seen = {r.op for r in drops.select("op").distinct().collect()}  # at most the two drop ops
    if policy.key == "index":
        # A drop clears the document only from the namespace that holds it at the time.
        documents = cleared_since_image(documents, drops, policy, bool(seen))
        ranges = order_ranges(rows, "seq")
        sums = {"_inserted": F.when(op == INSERT, seq), "_deleted": F.when(op == DELETE, seq),
                "_emptied": F.when((op == UPDATE) & F.col("_cleared"), seq)}
        updates = running_max(documents, keys, "seq", sums, ranges).where(op == UPDATE)
        removed: list[Column] = [F.col("_deleted"), F.col("_emptied"), F.when(F.col("_cleared"), seq)]
    else:
        ranges = order_ranges(rows, "seq")
        sums = {"_inserted": F.when(op == INSERT, seq), "_deleted": F.when(op == DELETE, seq)}
        updates = running_max(documents, keys, "seq", sums, ranges).where(op == UPDATE)
        removed = [F.col("_deleted")]
        for i, (kind, of) in enumerate(scopes(policy)):
            if kind in seen:
                name = f"_dropped_{i}"
                updates = last_before(*_keyed(updates, drops.where(op == kind), of), "seq", name, ranges).drop("_all")
                removed.append(F.col(name))
    gone = F.greatest(*removed, F.lit(None).cast(events.schema["seq"].dataType))
    orphan = F.col("_inserted").isNull() | (F.coalesce(gone, F.col("_inserted") - 1) > F.col("_inserted"))
    return updates.where(orphan).select(*CHANGE_COLUMNS, F.lit("update_without_target").alias("reason"))


def _keyed(updates: DataFrame, drops: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Updates and drops with the key columns they meet on; without any, one constant."""
    if keys:
        return updates, drops.select(*keys, "seq"), list(keys)
    return updates.withColumn("_all", F.lit(0)), drops.select(F.lit(0).alias("_all"), "seq"), ["_all"]
