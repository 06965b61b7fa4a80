"""Data model: change rows, field rules, index configuration and apply policies.

A *change row* has the columns ``seq BIGINT, op STRING, database STRING, collection STRING,
uid STRING`` and a document column ``doc`` (a struct, or JSON text with a declared schema).
``seq`` makes arrival order explicit: it must be unique per event and grow with arrival.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import types as T

from foldex.functions.analysis import STANDARD, Analyzer
from foldex.functions.mappers import Mapper

INSERT = "insert"
UPDATE = "update"
DELETE = "delete"
DROP = "drop"
DROP_DATABASE = "drop_database"

DOCUMENT_OPS = (INSERT, UPDATE, DELETE)
CONTROL_OPS = (DROP, DROP_DATABASE)
OPS = DOCUMENT_OPS + CONTROL_OPS

NAMESPACE = ("database", "collection")
CHANGE_COLUMNS = ("seq", "op", *NAMESPACE, "uid")
#: What a document state holds beside the document; see ``operators.states``.
STATE_COLUMNS = ("_insert_at", "_delete_at", "_image_at", "_alive")
EXT = "ext"
EXT_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


class MappingError(ValueError):
    """A rule does not fit the declared schema of its collection."""


@dataclass(frozen=True)
class FieldRule:
    """Maps one (dotted) source path to one index field.

    ``default`` may be a literal, a ``Column`` or a function without arguments returning either;
    it replaces a null value or an empty list. ``stored`` makes the value retrievable,
    ``keyword`` keeps text exact instead of analysed.
    """

    field: str
    index_field: str
    mapper: Mapper
    default: Any = None
    stored: bool = False
    keyword: bool = False
    date_format: str | None = None


@dataclass(frozen=True)
class ExtenderContext:
    """What an extender sees: the namespace, the source document and the mapped fields."""

    database: Column
    collection: Column
    source: Column
    target: Mapping[str, Column]


Extender = Callable[[ExtenderContext], Mapping[str, Column]]
Router = Callable[[Column, Column], Column]


def by_collection(database: Column, collection: Column) -> Column:
    """The default routing: one index per collection name."""
    return collection


@dataclass(frozen=True)
class IndexConfig:
    """Rules per collection plus the index-wide settings.

    ``schemas`` declares the document schema of collections whose ``doc`` column is JSON text.
    ``text_values`` renders dates and booleans as text; switch it off to keep them typed.
    ``strict_types`` has stores reject JSON documents with a value that a mapper would convert;
    ``store_tokens`` has them analyse text once, when it is written, into ``<field>_tokens``.
    """

    rules: Mapping[str, Sequence[FieldRule]] = field(default_factory=dict)
    schemas: Mapping[str, T.StructType] = field(default_factory=dict)
    route: Router = by_collection
    extender: Extender | None = None
    date_format: str = "yyyy-MM-dd"
    text_values: bool = True
    strict_paths: bool = False
    strict_types: bool = False
    store_tokens: bool = False
    analyzer: Analyzer = STANDARD
    analyzers: Mapping[str, Analyzer] = field(default_factory=dict)
    facets: Sequence[str] = ()
    facets_by_index: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def with_rules(self, collection: str, *rules: FieldRule) -> IndexConfig:
        """Adds rules to one collection."""
        merged = dict(self.rules)
        merged[collection] = (*merged.get(collection, ()), *rules)
        return replace(self, rules=merged)

    def with_analyzer(self, index: str, analyzer: Analyzer) -> IndexConfig:
        return replace(self, analyzers={**self.analyzers, index: analyzer})

    def with_facets(self, index: str, *dimensions: str) -> IndexConfig:
        return replace(self, facets_by_index={**self.facets_by_index, index: dimensions})

    def collections_where(self, index_field: str, test: Callable[[FieldRule], bool]) -> list[str]:
        """The collections with a rule for the field that passes a test."""
        return [c for c, rules in self.rules.items() if any(r.index_field == index_field and test(r) for r in rules)]

    def text_collections(self, index_field: str) -> list[str]:
        """Collections whose field is analysed text: mapped from strings and not marked as keyword."""
        return self.collections_where(
            index_field, lambda r: isinstance(r.mapper.data_type, T.StringType) and not r.keyword)

    def is_text(self, index_field: str) -> bool:
        """Whether any collection has the field as analysed text."""
        return bool(self.text_collections(index_field))

    def text_fields(self) -> list[str]:
        names = dict.fromkeys(r.index_field for rules in self.rules.values() for r in rules)
        return [n for n in names if self.is_text(n)]

    def stored_fields(self) -> list[str]:
        stored = (r.index_field for rules in self.rules.values() for r in rules if r.stored)
        return list(dict.fromkeys(stored))


_CHOICES = {
    "update": ("replace", "merge", "ignore"),
    "key": ("namespace", "index"),
    "drop_scope": ("namespace", "collection"),
    "drop_database": ("database", "all", "ignore"),
    "combine": ("append", "last"),
    "nulls": ("drop", "keep"),
}


@dataclass(frozen=True)
class ApplyPolicy:
    """How changes are applied; each back end the engine can stand in for is one combination.

    update         replace: an update writes the whole document; merge: it changes a document
                   that must exist; ignore: it has no effect
    key            namespace: a document is (database, collection, uid); index: (index_name, uid)
    drop_scope     namespace: a drop clears (database, collection); collection: it clears the
                   collection name inside the routed index, whatever the database
    drop_database  database: clears that database; all: clears every index; ignore
    combine        several rules on one index field: append the values, or the last rule wins
    nulls          drop: null list elements vanish; keep
    defaults       whether rule defaults are used
    """

    update: str = "replace"
    key: str = "namespace"
    drop_scope: str = "namespace"
    drop_database: str = "database"
    combine: str = "append"
    nulls: str = "drop"
    defaults: bool = True

    def __post_init__(self):
        for name, allowed in _CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")

    @property
    def key_columns(self) -> tuple[str, ...]:
        return ("uid", "collection", "database") if self.key == "namespace" else ("uid", "index_name")

    @property
    def drop_columns(self) -> tuple[str, ...]:
        return NAMESPACE if self.drop_scope == "namespace" else ("index_name", "collection")


EMBEDDED = ApplyPolicy(update="ignore", drop_scope="collection", drop_database="all")
PARTIAL_UPDATE = ApplyPolicy(
    update="merge", key="index", drop_scope="collection", drop_database="ignore",
    combine="last", nulls="keep", defaults=False,
)
FULL_REPLACE = ApplyPolicy(
    update="replace", key="index", drop_database="ignore", nulls="keep", defaults=False,
)
