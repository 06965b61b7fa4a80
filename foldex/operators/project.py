"""Projection of source documents through the field rules of their collection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.functions.extended_json import plain_json
from foldex.functions.mappers import Mapped, render_text
from foldex.model import (
    EXT,
    EXT_TYPE,
    NAMESPACE,
    STATE_COLUMNS,
    ApplyPolicy,
    ExtenderContext,
    FieldRule,
    IndexConfig,
    MappingError,
)

DEFAULT_POLICY = ApplyPolicy()


def _with_default(mapped: Mapped, rule: FieldRule) -> Mapped:
    value = rule.default() if callable(rule.default) else rule.default
    default = value if isinstance(value, Column) else F.lit(value)
    if not mapped.multi:
        return Mapped(F.coalesce(mapped.value, default), mapped.data_type, False)
    if not isinstance(value, list | tuple):
        default = F.array(default)
    default = default.cast(T.ArrayType(mapped.data_type))
    empty = mapped.value.isNull() | (F.size(mapped.value) == 0)
    return Mapped(F.when(empty, default).otherwise(mapped.value), mapped.data_type, True)


def _rule_value(rule: FieldRule, doc: Column, schema: T.StructType | T.VariantType, config: IndexConfig,
                policy: ApplyPolicy) -> Mapped:
    mapped = rule.mapper.compile(doc, schema, rule.field, config.strict_paths)
    apply_default = policy.defaults and rule.default is not None
    pattern = rule.date_format or config.date_format
    # A text default of a date or boolean rule is final text, so it goes in after rendering.
    late = config.text_values and not isinstance(mapped.data_type, T.StringType) and isinstance(rule.default, str)
    if apply_default and not late:
        mapped = _with_default(mapped, rule)
    if config.text_values:
        mapped = render_text(mapped, pattern)
    if apply_default and late:
        mapped = _with_default(mapped, rule)
    if mapped.multi and policy.nulls == "drop":
        mapped = Mapped(F.array_compact(mapped.value), mapped.data_type, True)
    return mapped


def _as_array(mapped: Mapped) -> Column:
    if not mapped.multi:
        return F.array(mapped.value)
    return F.coalesce(mapped.value, F.array().cast(T.ArrayType(mapped.data_type)))


def _combine(name: str, values: Sequence[Mapped], policy: ApplyPolicy) -> Mapped:
    """Several rules on one index field: append their values, or let the last rule win."""
    if len(values) == 1 or policy.combine == "last":
        return values[-1]
    if len({v.data_type.simpleString() for v in values}) > 1:
        raise MappingError(f"index field '{name}' combines different types")
    joined = F.concat(*[_as_array(v) for v in values])
    if policy.nulls == "drop":
        joined = F.array_compact(joined)
    return Mapped(joined, values[0].data_type, True)


def compile_rules(rules: Sequence[FieldRule], doc: Column, schema: T.StructType,
                  config: IndexConfig, policy: ApplyPolicy) -> dict[str, Mapped]:
    """Index field → compiled value, for the rules of one collection."""
    grouped: dict[str, list[Mapped]] = {}
    for rule in rules:
        grouped.setdefault(rule.index_field, []).append(_rule_value(rule, doc, schema, config, policy))
    return {name: _combine(name, values, policy) for name, values in grouped.items()}


def _groups(config: IndexConfig, schemas: dict[str, T.StructType]) -> list[tuple[list[str], Sequence[FieldRule]]]:
    """Collections that share rules and schema are compiled once."""
    groups: list[tuple[list[str], Sequence[FieldRule]]] = []
    for collection, rules in config.rules.items():
        for names, known in groups:
            if list(known) == list(rules) and schemas.get(names[0]) == schemas.get(collection):
                names.append(collection)
                break
        else:
            groups.append(([collection], rules))
    return groups


def _unify(name: str, branches: list[tuple[list[str], Mapped]], rows: set[str] | None = None) -> tuple[Column, T.DataType]:
    """One column for an index field that several collections fill; plain if all collections of the ``rows`` fill it alike."""
    if len({m.data_type.simpleString() for _, m in branches}) > 1:
        raise MappingError(f"index field '{name}' has different types in different collections")
    multi = any(m.multi for _, m in branches)
    element = branches[0][1].data_type

    def shaped(m: Mapped) -> Column:
        if multi and not m.multi:
            return F.when(m.value.isNotNull(), F.array(m.value))
        return m.value

    if rows is not None and set(branches[0][0]) == rows:
        return shaped(branches[0][1]), T.ArrayType(element) if multi else element
    collection = F.col("collection")
    value = reduce(
        lambda chain, b: chain.when(collection.isin(b[0]), shaped(b[1])), branches[1:],
        F.when(collection.isin(branches[0][0]), shaped(branches[0][1])),
    )
    return value, T.ArrayType(element) if multi else element


def _extension(config: IndexConfig, doc: Column, target: dict[str, Column]) -> Column:
    """The extender's values as a map of name → values; names without a value are absent."""
    context = ExtenderContext(F.col("database"), F.col("collection"), doc, target)
    added = config.extender(context)
    entries = [c for name, value in added.items() for c in (F.lit(name), value.cast("array<string>"))]
    filled = F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull() & (F.size(v) > 0))
    return filled.cast(EXT_TYPE)


def project(docs: DataFrame, config: IndexConfig, policy: ApplyPolicy = DEFAULT_POLICY,
            doc: str = "doc", ruled_only: bool = False) -> DataFrame:
    """Replaces ``doc`` by the index fields of its collection and adds ``index_name``.

    Works on batch and streaming rows alike, in one pass and without a shuffle. Collections
    without rules keep only their metadata columns. Documents are structs, variants, or JSON text: with a declared
    schema that is parsed as such, without one as a variant.

    With ``ruled_only`` rows of collections without rules are left out. A field that all other collections fill by the same
    rules then is a plain expression, so comparisons with it reach the scan.
    """
    if ruled_only:
        docs = docs.where(F.col("collection").isin(list(config.rules)))
    routed = docs.withColumn("index_name", config.route(F.col("database"), F.col("collection")))
    data_type = docs.schema[doc].dataType
    if isinstance(data_type, T.StructType | T.VariantType):
        schemas = {c: data_type for c in config.rules}
        sources = {c: F.col(doc) for c in config.rules}
    else:
        routed, schemas, sources = _parse_json(routed, config, doc)

    branches: dict[str, list[tuple[list[str], Mapped]]] = {}
    for names, rules in _groups(config, schemas):
        compiled = compile_rules(rules, sources[names[0]], schemas[names[0]], config, policy)
        for field_name, mapped in compiled.items():
            branches.setdefault(field_name, []).append((names, mapped))
    rows = set(config.rules) if ruled_only else None
    unified = {name: _unify(name, b, rows) for name, b in branches.items()}
    fields = {name: value for name, (value, _) in unified.items()}

    kept = [F.col(c) for c in docs.columns if c != doc]
    columns = [*kept, F.col("index_name"), *[v.alias(n) for n, v in fields.items()]]
    if config.extender is not None:
        columns.append(_extension(config, F.col(doc), fields).alias(EXT))
    return routed.select(*columns)


def _parse_json(docs: DataFrame, config: IndexConfig, doc: str):
    """JSON documents: one parsed column per declared schema, used only by its collections, and a variant for all others."""
    parsed, sources, schemas = {}, {}, {}
    for collection in config.rules:
        schema = schemas[collection] = config.schemas.get(collection, T.VariantType())
        name = next((n for n, (s, _) in parsed.items() if s == schema), f"_doc_{len(parsed)}")
        parsed.setdefault(name, (schema, []))[1].append(collection)
        sources[collection] = F.col(name)

    def read(schema: T.DataType) -> Column:
        text = plain_json(F.col(doc))
        return F.try_parse_json(text) if isinstance(schema, T.VariantType) else F.from_json(text, schema)

    out = docs.withColumns({
        name: F.when(F.col("collection").isin(users), read(schema)) for name, (schema, users) in parsed.items()
    })
    return out, schemas, sources


def payload_columns(projected: DataFrame) -> list[str]:
    """Index fields (and ``ext``) of a projected frame, without keys and change metadata."""
    reserved = {"seq", "op", *NAMESPACE, "uid", "index_name", "nth", "reject", "batch", *STATE_COLUMNS}
    return [c for c in projected.columns if c not in reserved]


def index_documents(rows: DataFrame) -> DataFrame:
    """Final shape of index documents: ``_id``, ``_collection``, ``_database`` and the fields."""
    fields = payload_columns(rows)
    return rows.select(
        "index_name",
        F.col("uid").alias("_id"),
        F.col("collection").alias("_collection"),
        F.col("database").alias("_database"),
        *fields,
    )
