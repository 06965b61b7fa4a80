"""Dotted paths over documents without a declared schema, as columns over variant values.

Values keep the type they have in the document: one of another type than a mapper asks for is no value, and a strict
store rejects its document. Everything else is as with a declared schema: a missing single step is null, a dotted list
path goes through documents and arrays of documents and gives an empty list when something is missing on the way, a single value at
its end becomes a list, and elements without the last field are left out. Arrays directly inside arrays are
not entered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.functions.paths import PathError

# The types of JSON values that a mapper accepts without conversion, by Spark type name.
ACCEPTED = {
    "string": ("STRING",),
    "timestamp": ("STRING", "TIMESTAMP", "TIMESTAMP_NTZ"),
    "boolean": ("BOOLEAN",),
    "int": ("BIGINT",),
    "bigint": ("BIGINT",),
    "float": ("DOUBLE", "FLOAT", "DECIMAL", "BIGINT"),
    "double": ("DOUBLE", "FLOAT", "DECIMAL", "BIGINT"),
}
ARRAY = "array<variant>"


def field_path(*steps: str) -> str:
    """The variant path of some field names. A name may hold one kind of quotes, not both."""
    for step in steps:
        if '"' in step and "'" in step:
            raise PathError(f"'{step}' has both kinds of quotes")
    return "$" + "".join(f"['{s}']" if '"' in s else f'["{s}"]' for s in steps)


def _get(value: Column, *steps: str) -> Column:
    return F.try_variant_get(value, field_path(*steps), "variant")


def _elements(value: Column) -> Column:
    """The elements of an array; null for anything else."""
    return F.try_variant_get(value, "$", ARRAY)


def _none() -> Column:
    return F.array().cast(ARRAY)


def kind_of(value: Column) -> Column:
    """The type name of a variant value, decimals without their digits; null for no value and for a null in the document."""
    kind = F.regexp_replace(F.schema_of_variant(value), r"^DECIMAL\(.*\)$", "DECIMAL")
    return F.nullif(kind, F.lit("VOID"))


def fits(value: Column, data_type: T.DataType) -> Column:
    """Whether a value has a type that the mapper takes as it is."""
    return kind_of(value).isin(list(ACCEPTED[data_type.simpleString()]))


def typed(value: Column, data_type: T.DataType) -> Column:
    return F.when(fits(value, data_type), F.try_variant_get(value, "$", data_type.simpleString()))


def leaf(doc: Column, path: str) -> Column:
    """The value under a path through embedded documents."""
    return _get(doc, *path.split("."))


def scalar_value(doc: Column, path: str, data_type: T.DataType) -> Column:
    return typed(leaf(doc, path), data_type)


def _below(step: str) -> Callable[[Column], Column]:
    """From a document to what it holds under a name: the elements of an array, or one value."""
    def found(parent: Column) -> Column:
        value = _get(parent, step)
        return F.coalesce(_elements(value), F.when(value.isNotNull(), F.array(value)), _none())
    return found


def leaves(doc: Column, path: str) -> Column:
    """All values at the end of a dotted path, in document order, as an array of variants."""
    *inner, last = path.split(".")
    reached = F.array(doc)
    for step in inner:
        reached = F.flatten(F.transform(reached, _below(step)))

    def values(parent: Column) -> Column:
        found = _get(parent, last)
        # A null in the document is a missing value here; within a list of values it is an element.
        single = F.when(found.isNotNull() & kind_of(found).isNotNull(), F.array(found))
        return F.coalesce(_elements(found), single, _none())

    return F.flatten(F.transform(reached, values))


def list_values(doc: Column, path: str, data_type: T.DataType) -> Column:
    found = leaves(doc, path) if "." in path else _elements(_get(doc, path))
    return F.transform(found, lambda v: typed(v, data_type))


def mismatch(doc: Column, path: str, data_type: T.DataType, multi: bool) -> Column:
    """Whether a value under the path, in whatever arrays, has a type that the mapper does not take; a null never has."""
    def wrong(value: Column) -> Column:
        return F.coalesce(~fits(value, data_type), F.lit(False))

    if not multi:
        return wrong(leaf(doc, path))
    if "." in path:
        return F.exists(leaves(doc, path), wrong)
    found = _get(doc, path)
    no_list = _elements(found).isNull() & kind_of(found).isNotNull()
    return no_list | F.coalesce(F.exists(_elements(found), wrong), F.lit(False))
