"""Change feeds, nested documents and text collections derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.model import CHANGE_COLUMNS
from foldex.sources.snapshot import snapshot


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(table: DataFrame, key: str) -> DataFrame:
    """Spreads a table that fits in a few splits over all cores, for work that is heavy per row.

    Tables with enough splits of their own, so all large ones, are left alone.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() * 2 <= cores else table


def uid(key: Column) -> Column:
    return F.lpad(key.cast("string"), 24, "0")


# -- change feed -----------------------------------------------------------------------------

EVENT_FIELDS = ["event_type", "value", "ts", "props"]


def change_columns() -> list[Column]:
    """Every event as a change: kinds, namespaces and keys follow from its own columns."""
    event_id, user_id, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    op = (
        F.when(event_id % 4001 == 3500, "drop_database")
        .when(event_id % 331 == 300, "drop")
        .when(kind == "signup", "insert")
        .when(kind == "error", "delete")
        .otherwise("update")
    )
    return [
        event_id.alias("seq"),
        op.alias("op"),
        F.when(user_id % 8 >= 4, "db1").otherwise("db0").alias("database"),
        F.concat(F.lit("c"), (user_id % 4).cast("string")).alias("collection"),
        uid(user_id * 8 + event_id % 8).alias("uid"),
    ]


def changes_of(events: DataFrame) -> DataFrame:
    return events.select(*change_columns(), F.struct(*EVENT_FIELDS).alias("doc"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_of(table(spark, sf_dir, "events"))


def event_doc_type(spark: SparkSession, sf_dir: str) -> T.DataType:
    return changes(spark, sf_dir).schema["doc"].dataType


def raw_events(events: DataFrame, fields: tuple[str, ...] = ("event_type", "value", "props")) -> DataFrame:
    """The same feed as JSON change events, one text value per event."""
    rows = changes_of(events)
    op = F.col("op")
    kind = F.when(op == "drop_database", "dropDatabase").otherwise(op)
    document = F.when(op.isin("insert", "update"), F.struct(*[f"doc.{f}" for f in fields]))
    key = F.when(
        op.isin("insert", "update", "delete"),
        F.struct(F.struct(F.col("uid").alias("$oid")).alias("_id")),
    )
    event = F.struct(
        "seq",
        kind.alias("operationType"),
        F.struct(F.col("database").alias("db"), F.col("collection").alias("coll")).alias("ns"),
        key.alias("documentKey"),
        document.alias("fullDocument"),
    )
    return rows.select(F.to_json(event).alias("value"))


# -- order documents: embedded documents ---------------------------------------------------------


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order, with its customer and the customer's home embedded."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    # Nations and regions are fixed lists; Spark broadcasts them by their size on its own.
    homes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        homes, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    home = F.struct(F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    buyer = F.struct(
        F.col("c_name").alias("name"), segment.alias("segment"), F.col("c_acctbal").alias("balance"),
        (F.col("c_acctbal") > 5000).alias("vip"), home.alias("home"),
    )
    fields = {
        "status": F.col("o_orderstatus"),
        "placed": F.col("o_orderdate"),
        "total": F.col("o_totalprice"),
        "cents": F.round(F.col("o_totalprice") * 100).cast("bigint"),
        "weight": F.col("o_totalprice").cast("float"),
        "rank": F.substring("o_orderpriority", 1, 1).cast("int"),
        "urgent": F.substring("o_orderpriority", 1, 1) == "1",
        "priority": F.col("o_orderpriority"),
        "buyer": buyer,
    }
    rows = joined.select("o_orderkey", *[c.alias(n) for n, c in fields.items()])
    return snapshot(rows, "shop", "orders", uid(F.col("o_orderkey")), list(fields))


# -- text documents: lists of documents -----------------------------------------------------------


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language as collections: whole text, source, length."""
    return snapshot(spread(table(spark, sf_dir, "documents"), "doc_id"), "corpus", F.col("lang"), uid(F.col("doc_id")),
                    ["text", "source", "n_chars", "lang"])


def outline_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts as nested documents: paragraphs holding sentences, two array levels.

    Built inside each row; no grouping is needed.
    """
    def sentence(s: Column) -> Column:
        return F.struct(
            s.alias("body"),
            F.length(s).alias("size"),
            F.length(s).cast("bigint").alias("size_long"),
            (F.length(s) / 2).cast("float").alias("half_float"),
            (F.length(s) / 2).cast("double").alias("half"),
            (F.length(s) > 80).alias("long"),
            F.timestamp_seconds(F.length(s).cast("bigint") * 86400).alias("day"),
        )

    def number(s: Column) -> Column:
        return F.nullif(F.regexp_extract(s, "[0-9]+", 0), F.lit(""))

    def paragraph(p: Column) -> Column:
        sentences = F.filter(F.split(p, r"\."), lambda s: s != "")
        return F.struct(
            F.nullif(F.split(p, " ")[0], F.lit("")).alias("opening"),
            number(p).alias("number"),
            F.split(p, ",").alias("clauses"),
            F.when(p != "", F.transform(sentences, sentence)).alias("sentences"),
        )

    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    outline = docs.select(
        "doc_id", "lang", "source",
        F.split("text", "\n").alias("lines"),
        F.transform(F.split("text", "\n"), number).alias("numbers"),
        F.struct(F.col("source").alias("name")).alias("origin"),
        F.transform(F.split("text", "\n"), paragraph).alias("paragraphs"),
    )
    return snapshot(outline, "corpus", F.col("lang"), uid(F.col("doc_id")),
                    ["source", "lines", "numbers", "origin", "paragraphs"])
