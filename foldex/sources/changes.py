"""Change feeds: raw change events to change rows, batch or streaming."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.model import DELETE, DROP, DROP_DATABASE, INSERT, UPDATE

# Event type names of the change feed and the ops they stand for.
EVENT_TYPES = {
    "insert": INSERT,
    "update": UPDATE,
    "delete": DELETE,
    "drop": DROP,
    "dropDatabase": DROP_DATABASE,
}

# Fixed value: the shape of a change event; keys and documents stay JSON text here.
EVENT_SCHEMA = (
    T.StructType()
    .add("seq", T.LongType())
    .add("operationType", T.StringType())
    .add("ns", T.StructType().add("db", T.StringType()).add("coll", T.StringType()))
    .add("documentKey", T.StructType().add("_id", T.StringType()))
    .add("fullDocument", T.StringType())
    .add("clusterTime", T.StructType().add("$timestamp", T.StructType().add("t", T.LongType()).add("i", T.LongType())))
)


def _object_id(key: Column) -> Column:
    """The hex text of a key, given as plain text or in the extended JSON form ``{"$oid": …}``."""
    return F.when(key.startswith("{"), F.get_json_object(key, "$['$oid']")).otherwise(key)


def normalise(events: DataFrame, event_types: Mapping[str, str] = EVENT_TYPES) -> DataFrame:
    """Structured change events to change rows.

    Needs ``seq, operationType, ns{db, coll}, documentKey{_id}, fullDocument``. A type that
    is not in ``event_types`` is kept as it is and later rejected as unknown.
    """
    kind = F.col("operationType")
    names = [F.lit(x) for pair in event_types.items() for x in pair]
    op = F.coalesce(F.create_map(*names)[kind], kind)
    return events.select(
        "seq",
        op.alias("op"),
        F.col("ns.db").alias("database"),
        F.col("ns.coll").alias("collection"),
        _object_id(F.col("documentKey._id")).alias("uid"),
        F.col("fullDocument").alias("doc"),
    )


def parse_events(lines: DataFrame, column: str = "value", event_types: Mapping[str, str] = EVENT_TYPES,
                 order: str | None = None) -> DataFrame:
    """JSON change events, one per row, to change rows with the document as JSON text.

    ``order`` names a column of the source that gives the order of arrival, such as the offset of a
    message queue. Without it an event's own ``seq`` counts, or else its cluster time.
    """
    event = F.from_json(F.col(column).cast("string"), EVENT_SCHEMA)
    time = F.col("_e.clusterTime").getField("$timestamp")
    stamp = F.shiftleft(time["t"], 32) + time["i"]
    seq = F.col("_order") if order else F.coalesce(F.col("_e.seq"), stamp)
    arrived = F.col(order).cast("bigint") if order else F.lit(None).cast("bigint")
    events = lines.select(event.alias("_e"), arrived.alias("_order"))
    return normalise(events.select(seq.alias("seq"), *[f"_e.{f.name}" for f in EVENT_SCHEMA if f.name not in ("seq", "clusterTime")]), event_types)


def stream_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                  event_types: Mapping[str, str] = EVENT_TYPES) -> DataFrame:
    """A stream over a growing folder of JSON-lines event files."""
    options = {"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger else {}
    return stream_source(spark, "text", {**options, "path": path}, event_types)


def stream_table(spark: SparkSession, path: str, schema: T.StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream over a growing folder of Parquet files with a declared schema."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_source(spark: SparkSession, source_format: str, options: Mapping[str, str],
                  event_types: Mapping[str, str] = EVENT_TYPES, order: str | None = None) -> DataFrame:
    """JSON events from any streaming source with a ``value`` column whose package is present."""
    lines = spark.readStream.format(source_format).options(**options).load()
    return parse_events(lines, event_types=event_types, order=order)
