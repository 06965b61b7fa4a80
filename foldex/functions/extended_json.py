"""Extended JSON: typed values written as one-key objects, made plain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The forms of ids, numbers and dates in extended JSON. Inside JSON text a quote is escaped, so
# text that looks like one of these does not match.
TEXT = r'\{\s*"\$(?:oid|symbol|uuid)"\s*:\s*("(?:[^"\\]|\\.)*+")\s*\}'
NUMBER = r'\{\s*"\$(?:numberInt|numberLong|numberDouble|numberDecimal)"\s*:\s*"(-?[0-9][0-9.eE+-]*)"\s*\}'
NO_NUMBER = r'\{\s*"\$(?:numberDouble|numberDecimal)"\s*:\s*("-?(?:NaN|Infinity)")\s*\}'
DATE_TEXT = r'\{\s*"\$date"\s*:\s*("[^"]*")\s*\}'
DATE_MILLIS = r'\{\s*"\$date"\s*:\s*(-?[0-9]+)\s*\}'


def plain_json(text: Column) -> Column:
    """JSON text with extended values replaced by plain ones: numbers, and text for ids and dates (ISO, UTC)."""
    plain = F.regexp_replace(text, TEXT, "$1")
    plain = F.regexp_replace(plain, NUMBER, "$1")
    plain = F.regexp_replace(plain, NO_NUMBER, "$1")
    plain = F.regexp_replace(plain, DATE_TEXT, "$1")
    # Milliseconds become text one by one: the gaps between them are joined with what replaces them.
    millis = F.regexp_extract_all(plain, F.lit(DATE_MILLIS), F.lit(1))
    dates = F.transform(millis, lambda m: F.concat(
        F.lit('"'), F.date_format(F.timestamp_millis(m.cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"), F.lit('"')))
    parts = F.zip_with(F.split(plain, DATE_MILLIS, -1), dates, lambda gap, date: F.concat(gap, F.coalesce(date, F.lit(""))))
    return F.when(F.contains(text, F.lit('"$')), F.array_join(parts, "")).otherwise(text)
