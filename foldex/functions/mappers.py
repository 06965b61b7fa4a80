"""Typed value mappers: what a field rule reads from a document.

``to_string, to_date, to_boolean, to_integer, to_long, to_float, to_double`` and ``to_null`` give
one value, the ``*_list`` forms give all values under the path. A mapper never converts: the
schema must already hold the asked type. Documents without a schema are variants, read value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.functions.paths import list_path, scalar_path
from foldex.functions.variants import list_values, scalar_value


class TypeMismatch(ValueError):
    """The document schema holds another type than the mapper asks for."""


@dataclass(frozen=True)
class Mapped:
    """A compiled value: ``data_type`` is the element type when ``multi`` is set."""

    value: Column
    data_type: T.DataType
    multi: bool


def _fits(found: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.TimestampType):
        return isinstance(found, T.TimestampType | T.TimestampNTZType)
    return type(found) is type(wanted)


@dataclass(frozen=True)
class Mapper:
    data_type: T.DataType
    multi: bool = False
    custom: Callable[[str, Column], Column] | None = None

    def compile(self, doc: Column, schema: T.StructType | T.VariantType, path: str, strict: bool = False) -> Mapped:
        if self.custom is not None:
            return Mapped(self.custom(path, doc), self.data_type, self.multi)
        if isinstance(self.data_type, T.NullType):
            return Mapped(F.lit(None).cast("string"), T.StringType(), False)
        if isinstance(schema, T.VariantType):
            return Mapped((list_values if self.multi else scalar_value)(doc, path, self.data_type), self.data_type, self.multi)
        found = (list_path if self.multi else scalar_path)(doc, schema, path)
        if found is None:
            if strict:
                raise TypeMismatch(f"no path '{path}' in {schema.simpleString()}")
            return self._absent(path)
        value, data_type = found
        if not _fits(data_type, self.data_type):
            raise TypeMismatch(
                f"'{path}' holds {data_type.simpleString()}, the rule asks for {self.data_type.simpleString()}"
            )
        return Mapped(value, data_type, self.multi)

    def _absent(self, path: str) -> Mapped:
        if not self.multi:
            return Mapped(F.lit(None).cast(self.data_type), self.data_type, False)
        array_type = T.ArrayType(self.data_type)
        value = F.array().cast(array_type) if "." in path else F.lit(None).cast(array_type)
        return Mapped(value, self.data_type, True)


to_null = Mapper(T.NullType())
to_string = Mapper(T.StringType())
to_date = Mapper(T.TimestampType())
to_boolean = Mapper(T.BooleanType())
to_integer = Mapper(T.IntegerType())
to_long = Mapper(T.LongType())
to_float = Mapper(T.FloatType())
to_double = Mapper(T.DoubleType())

to_string_list = Mapper(T.StringType(), multi=True)
to_date_list = Mapper(T.TimestampType(), multi=True)
to_boolean_list = Mapper(T.BooleanType(), multi=True)
to_integer_list = Mapper(T.IntegerType(), multi=True)
to_long_list = Mapper(T.LongType(), multi=True)
to_float_list = Mapper(T.FloatType(), multi=True)
to_double_list = Mapper(T.DoubleType(), multi=True)


def custom(fn: Callable[[str, Column], Column], data_type: T.DataType, multi: bool = False) -> Mapper:
    """A user mapper: ``fn(path, doc)`` returns a column (built-ins, or a pandas UDF if it must)."""
    return Mapper(data_type, multi, fn)


def date_text(value: Column, data_type: T.DataType, pattern: str) -> Column:
    """An instant as text in UTC, whatever the session time zone."""
    if isinstance(data_type, T.TimestampNTZType):
        return F.date_format(value, pattern)
    return F.date_format(F.to_utc_timestamp(value, F.current_timezone()), pattern)


def render_text(mapped: Mapped, pattern: str) -> Mapped:
    """Dates and booleans as text; other types stay as they are."""
    if isinstance(mapped.data_type, T.BooleanType):
        shape = "array<string>" if mapped.multi else "string"
        return Mapped(mapped.value.cast(shape), T.StringType(), mapped.multi)
    if isinstance(mapped.data_type, T.TimestampType | T.TimestampNTZType):
        if mapped.multi:
            text = F.transform(mapped.value, lambda v: date_text(v, mapped.data_type, pattern))
        else:
            text = date_text(mapped.value, mapped.data_type, pattern)
        return Mapped(text, T.StringType(), mapped.multi)
    return mapped
