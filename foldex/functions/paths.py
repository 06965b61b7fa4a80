"""Dotted document paths compiled to columns, driven by the declared schema.

Array steps use struct-field extraction over whole arrays plus ``flatten``, which stays in
generated code and lets the scan read only the nested fields a path touches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class PathError(ValueError):
    """A path that cannot be followed in the given schema."""


def _field(schema: T.StructType, name: str) -> T.StructField | None:
    return next((f for f in schema.fields if f.name == name), None)


def scalar_path(doc: Column, schema: T.StructType, path: str) -> tuple[Column, T.DataType] | None:
    """Value of a path through embedded documents; ``None`` if the schema has no such path."""
    value, data_type = doc, schema
    for step in path.split("."):
        if not isinstance(data_type, T.StructType):
            raise PathError(f"'{path}': '{step}' is not inside a document but {data_type.simpleString()}")
        found = _field(data_type, step)
        if found is None:
            return None
        value, data_type = value.getField(step), found.dataType
    return value, data_type


def list_path(doc: Column, schema: T.StructType, path: str) -> tuple[Column, T.DataType] | None:
    """All values under a path through documents and arrays of documents, in document order.

    Returns the array column and its element type. A single step is taken as it is, so a missing
    list stays null; a dotted path gives an empty array when an intermediate is missing, wraps a
    scalar leaf into a list, and skips array elements that lack the leaf.
    """
    steps = path.split(".")
    if len(steps) == 1:
        found = _field(schema, path)
        if found is None:
            return None
        if not isinstance(found.dataType, T.ArrayType):
            raise PathError(f"'{path}' is not a list but {found.dataType.simpleString()}")
        return doc.getField(path), found.dataType.elementType

    value, data_type, inside_list = doc, schema, False
    for i, step in enumerate(steps):
        if isinstance(data_type, T.ArrayType):
            # An array met half way: go on with its elements.
            data_type = data_type.elementType
            inside_list = True
            if isinstance(data_type, T.ArrayType):
                raise PathError(f"'{path}': a list of lists before '{step}'")
        if not isinstance(data_type, T.StructType):
            return None  # only documents have fields below them
        found = _field(data_type, step)
        if found is None:
            return None
        value, data_type = value.getField(step), found.dataType
        if inside_list and isinstance(data_type, T.ArrayType):
            value = F.flatten(F.array_compact(value))

    if isinstance(data_type, T.ArrayType):
        element, values = data_type.elementType, value
    elif inside_list:
        element, values = data_type, F.array_compact(value)
    else:
        element, values = data_type, F.array_compact(F.array(value))
    return F.coalesce(values, F.array().cast(T.ArrayType(element))), element
