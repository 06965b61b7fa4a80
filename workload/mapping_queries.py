"""Projection, analysis and read queries over order, text and outline documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex import Analyzer, ApplyPolicy, FieldRule, IndexConfig, IndexStore, IndexView, all_of, index_documents, match_all, project
from foldex.functions import mappers as m
from foldex.operators import rejects as R
from foldex.plans.counts import MaintainedCounts
from foldex.plans.postings import InvertedIndex
from foldex.plans.rebuild import RebuildMetrics, backfill, reindex, reindex_changed
from foldex.plans.store import save_table
from foldex.session import scratch
from foldex.sources.snapshot import scan_collections, source_counts
from workload import derive

LANGUAGES = ["de", "en", "es", "fr"]
GERMAN_STOP_WORDS = ["der", "die", "das", "und", "ist", "ein", "eine", "zu", "in", "den"]
ENGLISH_STOP_WORDS = ["the", "a", "an", "and", "is", "of", "to", "in", "it", "that"]
KEEP_NULLS = ApplyPolicy(nulls="keep", defaults=False)
LAST_WINS = ApplyPolicy(combine="last")


def rule(field: str, name: str, mapper: m.Mapper, **options) -> FieldRule:
    return FieldRule(field, name, mapper, **options)


def joined(values: Column, separator: str = "|") -> Column:
    """A list as one comparable value."""
    return F.md5(F.array_join(values, separator))


def size(values: Column) -> Column:
    return F.size(values).cast("bigint")


# -- sources -------------------------------------------------------------------------------------


def snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_collections(derive.text_documents(spark, sf_dir), LANGUAGES)
    return docs.select("database", "collection", "uid", F.col("doc.source").alias("source"),
                       F.col("doc.n_chars").alias("n_chars"), F.md5("doc.text").alias("text_md5"))


def count_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_counts(derive.text_documents(spark, sf_dir))


# -- scalar rules ----------------------------------------------------------------------------------


def orders_index(spark: SparkSession, sf_dir: str, *rules: FieldRule, policy: ApplyPolicy | None = None,
                 **settings) -> DataFrame:
    config = IndexConfig(rules={"orders": rules}, **settings)
    rows = project(derive.order_documents(spark, sf_dir), config, policy or ApplyPolicy())
    return index_documents(rows).drop("index_name", "_collection", "_database")


def map_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_index(spark, sf_dir, rule("status", "status", m.to_string), rule("priority", "prio", m.to_string),
                        rule("absent", "absent", m.to_string))


def map_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_index(
        spark, sf_dir, rule("buyer.name", "buyer", m.to_string), rule("buyer.segment", "segment", m.to_string),
        rule("buyer.home.nation", "nation", m.to_string), rule("buyer.home.region", "region", m.to_string))


def map_null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_index(spark, sf_dir, rule("status", "nothing", m.to_null),
                        rule("status", "note", m.to_null, default=lambda: "n/a"))


def map_date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_index(spark, sf_dir, rule("placed", "placed", m.to_date),
                        rule("placed", "placed_compact", m.to_date, date_format="yyyyMMdd'T'HHmmss"),
                        rule("placed", "placed_month", m.to_date, date_format="yyyy/MM"))


def map_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_index(spark, sf_dir, rule("urgent", "urgent", m.to_boolean), rule("buyer.vip", "vip", m.to_boolean))


def map_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_index(spark, sf_dir, rule("rank", "rank", m.to_integer), rule("cents", "cents", m.to_long),
                        rule("weight", "weight", m.to_float), rule("total", "total", m.to_double))


def map_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_index(spark, sf_dir, rule("buyer.segment", "segment", m.to_string, default="none"),
                        rule("absent", "rank", m.to_integer, default=7))


def numeric_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = text_view(spark, sf_dir, ruled_only=True)
    hits = view.where(view.between("n_chars", 500, 5000)).documents
    return hits.select("_id", "_collection", "n_chars")


# -- documents without a schema --------------------------------------------------------------------


def as_json(documents: DataFrame) -> DataFrame:
    """The documents as JSON text; nothing is declared about them."""
    return documents.withColumn("doc", F.to_json("doc", {"ignoreNullFields": "false"}))


def map_variant_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scalar mapper on documents without a schema, through embedded documents, missing and null values."""
    rules = (
        rule("status", "status", m.to_string), rule("absent", "absent", m.to_string, default="none"),
        rule("buyer.segment", "segment", m.to_string), rule("buyer.home.nation", "nation", m.to_string),
        rule("placed", "placed", m.to_date), rule("buyer.vip", "vip", m.to_boolean), rule("rank", "rank", m.to_integer),
        rule("cents", "cents", m.to_long), rule("weight", "weight", m.to_float), rule("total", "total", m.to_double),
        rule("cents", "no_text", m.to_string))
    rows = project(as_json(derive.order_documents(spark, sf_dir)), IndexConfig(rules={"orders": rules}))
    return index_documents(rows).drop("index_name", "_collection", "_database")


def map_variant_list_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List mappers on documents without a schema, through one and two levels of arrays of documents."""
    rules = (
        rule("lines", "lines", m.to_string_list), rule("paragraphs.opening", "openings", m.to_string_list),
        rule("paragraphs.clauses", "clauses", m.to_string_list), rule("paragraphs.sentences.body", "bodies", m.to_string_list),
        rule("paragraphs.sentences.size", "sizes", m.to_integer_list), rule("origin.name", "origins", m.to_string_list),
        rule("origin.missing", "missing", m.to_string_list), rule("paragraphs.number", "numbers", m.to_string_list, default="none"))
    config = IndexConfig(rules={lang: rules for lang in LANGUAGES})
    df = index_documents(project(as_json(derive.outline_documents(spark, sf_dir)), config))
    return df.select(
        "_id", joined(F.col("lines"), "\n").alias("lines_md5"), joined(F.col("openings")).alias("openings_md5"),
        joined(F.col("clauses")).alias("clauses_md5"), size(F.col("bodies")).alias("n"), joined(F.col("bodies")).alias("bodies_md5"),
        F.array_max("sizes").alias("max_size"), F.col("origins")[0].alias("origin"), size(F.col("missing")).alias("n_missing"),
        joined(F.col("numbers")).alias("numbers_md5"))


# A sentence of 150 characters or more in JSON, without quotes and backslashes; other escapes count as one character.
LONG_BODY = r'"body":"(?:[^"\\]|\\[bfnrt/]|\\u[0-9A-Fa-f]{4}){150,}+"'


def strict_types_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a strict store rejects for a value inside arrays of documents: here long sentences, as numbers."""
    docs = as_json(derive.outline_documents(spark, sf_dir))
    number = F.regexp_replace("doc", LONG_BODY, '"body":150')
    changes = docs.select(F.col("uid").cast("bigint").alias("seq"), F.lit("insert").alias("op"), "database", "collection", "uid",
                          number.alias("doc"))
    config = IndexConfig(rules={lang: (rule("paragraphs.sentences.body", "bodies", m.to_string_list),) for lang in LANGUAGES})
    return R.type_mismatches(changes, config).select("uid", "reason")


# -- list rules ------------------------------------------------------------------------------------


def outline_index(spark: SparkSession, sf_dir: str, *rules: FieldRule, policy: ApplyPolicy | None = None,
                  **settings) -> DataFrame:
    config = IndexConfig(rules={lang: rules for lang in LANGUAGES}, **settings)
    return index_documents(project(derive.outline_documents(spark, sf_dir), config, policy or ApplyPolicy()))


def map_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = outline_index(spark, sf_dir, rule("lines", "lines", m.to_string_list))
    return df.select("_id", size(F.col("lines")).alias("n"), joined(F.col("lines"), "\n").alias("lines_md5"))


def map_list_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = outline_index(spark, sf_dir, rule("paragraphs.opening", "openings", m.to_string_list),
                       rule("paragraphs.clauses", "clauses", m.to_string_list))
    return df.select("_id", size(F.col("openings")).alias("n_openings"), joined(F.col("openings")).alias("openings_md5"),
                     size(F.col("clauses")).alias("n_clauses"), joined(F.col("clauses")).alias("clauses_md5"))


def map_list_path_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = outline_index(spark, sf_dir, rule("paragraphs.sentences.body", "bodies", m.to_string_list))
    return df.select("_id", size(F.col("bodies")).alias("n"), joined(F.col("bodies")).alias("bodies_md5"))


def map_list_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = outline_index(spark, sf_dir, rule("origin.name", "origins", m.to_string_list),
                       rule("origin.missing", "missing", m.to_string_list))
    return df.select("_id", size(F.col("origins")).alias("n"), F.col("origins")[0].alias("origin"),
                     size(F.col("missing")).alias("n_missing"))


def map_list_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = "paragraphs.sentences."
    df = outline_index(
        spark, sf_dir,
        rule(path + "size", "ints", m.to_integer_list), rule(path + "size_long", "longs", m.to_long_list),
        rule(path + "half_float", "floats", m.to_float_list), rule(path + "half", "doubles", m.to_double_list),
        rule(path + "long", "flags", m.to_boolean_list), rule(path + "day", "days", m.to_date_list))
    return df.select(
        "_id", F.array_max("ints").alias("max_int"), F.array_min("longs").alias("min_long"),
        F.array_max("floats").alias("max_float"), F.array_min("doubles").alias("min_double"),
        joined(F.col("longs")).alias("longs_md5"), joined(F.col("flags")).alias("flags_md5"),
        joined(F.col("days")).alias("days_md5"))


def map_list_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = rule("numbers", "numbers", m.to_string_list)
    dropped = outline_index(spark, sf_dir, numbers)
    kept = outline_index(spark, sf_dir, numbers, policy=KEEP_NULLS)
    left = dropped.select("_id", F.lit("drop").alias("nulls"), "numbers")
    both = left.unionByName(kept.select("_id", F.lit("keep").alias("nulls"), "numbers"))
    return both.select("_id", "nulls", size(F.col("numbers")).alias("n"), joined(F.col("numbers")).alias("numbers_md5"))


def map_default_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = outline_index(spark, sf_dir, rule("paragraphs.number", "numbers", m.to_string_list, default="none"))
    return df.select("_id", size(F.col("numbers")).alias("n"), joined(F.col("numbers")).alias("numbers_md5"))


def map_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    shout = m.custom(lambda path, doc: F.upper(doc.getField(path)), T.StringType())
    ends = m.custom(lambda path, doc: F.array(doc[path][0], F.element_at(doc[path], -1)), T.StringType(), multi=True)
    df = outline_index(spark, sf_dir, rule("source", "source", shout), rule("lines", "ends", ends))
    return df.select("_id", "source", joined(F.col("ends")).alias("ends_md5"))


COMBINED = (rule("paragraphs.number", "names", m.to_string_list), rule("source", "names", m.to_string))


def map_combine_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = outline_index(spark, sf_dir, *COMBINED)
    return df.select("_id", size(F.col("names")).alias("n"), joined(F.col("names")).alias("names_md5"))


def map_combine_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outline_index(spark, sf_dir, *COMBINED, policy=LAST_WINS).select("_id", "names")


# -- text documents --------------------------------------------------------------------------------

TEXT_RULES = (
    rule("text", "text", m.to_string),
    rule("source", "source", m.to_string, stored=True, keyword=True),
    rule("n_chars", "n_chars", m.to_long, stored=True),
)
TEXT_CONFIG = IndexConfig(rules={lang: TEXT_RULES for lang in LANGUAGES}, facets=("source", "_collection"))


def text_view(spark: SparkSession, sf_dir: str, config: IndexConfig = TEXT_CONFIG, ruled_only: bool = False) -> IndexView:
    projected = project(derive.text_documents(spark, sf_dir), config, ruled_only=ruled_only)
    return IndexView(index_documents(projected), config)


def project_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different rules per collection; one of them has none."""
    config = IndexConfig(rules={
        "de": TEXT_RULES, "en": TEXT_RULES,
        "es": (rule("n_chars", "n_chars", m.to_long), rule("lang", "source", m.to_string)),
    })
    df = text_view(spark, sf_dir, config).documents
    return df.withColumn("text_md5", F.md5("text")).drop("text")


def route_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Romance languages share one index, the others are routed by database and collection."""
    def route(database: Column, collection: Column) -> Column:
        return F.when(collection.isin("es", "fr"), "romance").otherwise(F.concat_ws("_", database, collection))

    view = text_view(spark, sf_dir, IndexConfig(rules=TEXT_CONFIG.rules, route=route))
    return view.documents.groupBy("index_name", "_collection").agg(
        F.count(F.lit(1)).alias("n"), F.max("_id").alias("last_id"))


def extender_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    def extend(ctx) -> dict[str, Column]:
        return {
            "tags": F.array(ctx.collection, ctx.source["source"]),
            "long": F.when(ctx.target["n_chars"] > 2000, F.array(F.lit("yes"))),
        }

    view = text_view(spark, sf_dir, IndexConfig(rules=TEXT_CONFIG.rules, extender=extend))
    return view.documents.select("_id", F.array_join(F.col("ext")["tags"], "|").alias("tags"),
                                 F.col("ext")["long"][0].alias("long"))


def analyze_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = text_view(spark, sf_dir).analysed("text")
    return df.select("_id", size(F.col("text_tokens")).alias("n"), joined(F.col("text_tokens"), " ").alias("tokens_md5"))


def analyze_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = text_view(spark, sf_dir).analysed("source")
    return df.select("_id", size(F.col("source_tokens")).alias("n"), F.col("source_tokens")[0].alias("token"))


def analyze_per_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """German and English texts get their own stop words, other indices the default analyser."""
    config = TEXT_CONFIG.with_analyzer("de", Analyzer(by_field={"text": Analyzer(stop_words=GERMAN_STOP_WORDS)}))
    config = config.with_analyzer("en", Analyzer(stop_words=ENGLISH_STOP_WORDS))
    df = text_view(spark, sf_dir, config).analysed("text")
    return df.select("_id", size(F.col("text_tokens")).alias("n"), joined(F.col("text_tokens"), " ").alias("tokens_md5"))


def stored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_view(spark, sf_dir).stored()


# -- queries -----------------------------------------------------------------------------------------


def term_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = text_view(spark, sf_dir)
    return view.where(view.term("text", "la")).documents.select("_id", "_collection", "source")


def bool_must_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = text_view(spark, sf_dir)
    condition = all_of(view.term("_database", "corpus"), view.term("_collection", "fr"),
                       view.term("source", "src4"), view.term("text", "le"))
    return view.where(condition).documents.select("_id", "source", "n_chars")


def match_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = text_view(spark, sf_dir)
    return view.where(view.match("text", "Der TION, pour the")).documents.select("_id", "_collection")


def index_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_view(spark, sf_dir).where(match_all()).index_counts()


def get_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents named by the label table."""
    ids = derive.table(spark, sf_dir, "labels").select(derive.uid(F.col("doc_id")).alias("_id"))
    return text_view(spark, sf_dir).get_many(ids).select("_id", "_collection", "source", "n_chars")


FACET_CONFIG = IndexConfig(
    rules={lang: (rule("source", "source", m.to_string, keyword=True),
                  rule("paragraphs.opening", "openings", m.to_string_list, keyword=True)) for lang in LANGUAGES},
    facets=("source",),
    facets_by_index={"en": ("source", "openings"), "fr": ("openings",)},
)


def facet_view(spark: SparkSession, sf_dir: str) -> IndexView:
    return IndexView(index_documents(project(derive.outline_documents(spark, sf_dir), FACET_CONFIG)), FACET_CONFIG)


def facet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facet_view(spark, sf_dir).facet_rows().select("index_name", "_id", "dim", "value")


def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facet_view(spark, sf_dir).facets()


def facet_counts_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = text_view(spark, sf_dir)
    return view.facets(all_of(view.term("_collection", "en"), view.term("text", "the")))


def term_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_view(spark, sf_dir).postings("text").select("term", "_id", "tf")


def stored_index(spark: SparkSession, sf_dir: str, config: IndexConfig = TEXT_CONFIG) -> IndexStore:
    """The text documents committed to a store, from nothing but a backfill."""
    docs = derive.text_documents(spark, sf_dir)
    store = IndexStore(spark, scratch(spark, "store"), config, docs.schema["doc"].dataType)
    backfill(docs)(store)
    return store


def reindex_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log rows that a rebuild writes where few documents differ from the index, and the index after it."""
    docs = derive.text_documents(spark, sf_dir)
    number = F.col("uid").cast("bigint")
    store = IndexStore(spark, scratch(spark, "store"), TEXT_CONFIG, docs.schema["doc"].dataType)
    changed = F.col("doc").withField("source", F.lit("elsewhere"))
    backfill(docs.withColumn("doc", F.when(number % 100 == 7, changed).otherwise(F.col("doc"))).where(number % 100 != 8))(store)
    batch = reindex_changed(docs.where(number % 100 != 9), LANGUAGES, "corpus")(store)
    log = store.log([batch]).select(F.col("op").alias("kind"), F.col("uid").alias("_id"), F.col("collection").alias("_collection"), "source")
    view = store.view().documents.select(F.lit("document").alias("kind"), "_id", "_collection", "source")
    return log.unionByName(view)


def reindex_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a rebuild read, indexed and rejected per collection, observed while it wrote."""
    docs = derive.text_documents(spark, sf_dir)
    store = IndexStore(spark, scratch(spark, "store"), TEXT_CONFIG, docs.schema["doc"].dataType)
    metrics = RebuildMetrics(["en", "de"])
    keyless = docs.withColumn("uid", F.when(F.col("uid").cast("bigint") % 17 != 0, F.col("uid")))
    reindex(keyless, metrics.collections, "corpus", metrics)(store)
    return spark.createDataFrame(metrics.rows(), "collection string, n_read bigint, n_indexed bigint, n_rejected bigint")


def index_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index documents committed to a store, one folder per index, and read back."""
    back = stored_index(spark, sf_dir).view().documents
    return back.select("index_name", "_id", "_collection", "_database", "source", "n_chars",
                       F.md5("text").alias("text_md5"))


def catalog_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index documents as a catalog table bucketed by id."""
    name = f"roundtrip_{uuid.uuid4().hex}"
    save_table(text_view(spark, sf_dir).documents, name, buckets=4, path=scratch(spark, "table"))
    return spark.table(name).select("index_name", "_id", "_collection", "_database", "source", "n_chars",
                                    F.md5("text").alias("text_md5"))


def term_query_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A term in an index whose text was analysed when it was written."""
    view = stored_index(spark, sf_dir, replace(TEXT_CONFIG, store_tokens=True)).view()
    return view.where(view.term("text", "la")).documents.select("_id", "_collection", "source")


def followed_store(spark: SparkSession, sf_dir: str, follow: Callable[[IndexStore], object]) -> tuple:
    """A store after a backfill with stale texts and a feed of inserts, updates and deletes, and what followed it."""
    docs = derive.text_documents(spark, sf_dir)
    number = F.col("uid").cast("bigint")
    store = IndexStore(spark, scratch(spark, "store"), TEXT_CONFIG, docs.schema["doc"].dataType)
    stale = F.col("doc").withField("text", F.lit("la stale text the")).withField("source", F.lit("nowhere"))
    backfill(docs.where(number % 10 != 3).withColumn("doc", F.when(number % 4 == 1, stale).otherwise(F.col("doc"))))(store)
    follower = follow(store)
    follower.refresh()
    op = F.when(number % 11 == 5, "delete").when(number % 10 == 3, "insert").when(number % 4 == 1, "update")
    changes = docs.select((number + 1).alias("seq"), op.alias("op"), "database", "collection", "uid", "doc").where("op is not null")
    store.append(changes)
    store.compact()
    follower.refresh()
    return store, follower


def inverted_index(spark: SparkSession, sf_dir: str) -> InvertedIndex:
    return followed_store(spark, sf_dir, InvertedIndex)[1]


def maintained_counts(spark: SparkSession, sf_dir: str) -> MaintainedCounts:
    """Counts that followed a store, at last over a drop of its French documents."""
    store, counts = followed_store(spark, sf_dir, MaintainedCounts)
    french = derive.text_documents(spark, sf_dir).where(F.col("collection") == "fr")
    store.append(french.select("database", "collection").distinct().select(
        F.lit(store.head().as_of_seq + 1).cast("bigint").alias("seq"), F.lit("drop").alias("op"), "database", "collection",
        F.lit(None).cast("string").alias("uid"), F.lit(None).cast(french.schema["doc"].dataType).alias("doc")))
    store.compact()
    counts.refresh()
    return counts


def collection_size_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per collection from signed counts alone."""
    return maintained_counts(spark, sf_dir).sizes()


def facet_counts_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per facet value from signed counts alone."""
    return maintained_counts(spark, sf_dir).facets()


def term_query_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A term looked up in stored postings."""
    return inverted_index(spark, sf_dir).term("text", "la").select("_id", "_collection")


def match_query_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inverted_index(spark, sf_dir).match("text", "Der TION, pour the").select("_id", "_collection")


def term_postings_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inverted_index(spark, sf_dir).postings("text").select("term", "_id", "tf")


def facet_counts_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inverted_index(spark, sf_dir).facets()


def facet_counts_filtered_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inverted_index(spark, sf_dir).facets({"_collection": "en", "text": "the"})


def match_per_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query text is analysed as each index analyses: English keeps its case."""
    view = text_view(spark, sf_dir, TEXT_CONFIG.with_analyzer("en", Analyzer(lower=False)))
    return view.where(view.match("text", "The LA")).documents.select("_id", "_collection")


def keyword_per_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole German texts are keywords, other texts are analysed; a source is text in English alone."""
    keyword = (rule("text", "text", m.to_string, keyword=True), *TEXT_RULES[1:])
    text = (TEXT_RULES[0], rule("source", "source", m.to_string), TEXT_RULES[2])
    view = text_view(spark, sf_dir, replace(TEXT_CONFIG, rules={**TEXT_CONFIG.rules, "de": keyword, "en": text}))
    found = view.term("text", "die") | view.term("source", "src4")
    return view.where(found).documents.select("_id", "_collection", "source")


def stored_per_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values come back from the collections that store them."""
    hidden = tuple(replace(r, stored=False) for r in TEXT_RULES)
    return text_view(spark, sf_dir, replace(TEXT_CONFIG, rules={**TEXT_CONFIG.rules, "en": hidden, "de": TEXT_RULES[:2]})).stored()


QUERIES = {
    "snapshot_scan": snapshot_scan,
    "source_counts": count_sources,
    "map_scalar": map_scalar,
    "map_variant_scalar": map_variant_scalar,
    "map_variant_list_deep": map_variant_list_deep,
    "strict_types_nested": strict_types_nested,
    "map_embedded": map_embedded,
    "map_null_default": map_null_default,
    "map_date_format": map_date_format,
    "map_boolean": map_boolean,
    "map_numeric": map_numeric,
    "map_default": map_default,
    "map_default_list": map_default_list,
    "map_list": map_list,
    "map_list_path": map_list_path,
    "map_list_path_deep": map_list_path_deep,
    "map_list_wrap": map_list_wrap,
    "map_list_typed": map_list_typed,
    "map_list_nulls": map_list_nulls,
    "map_custom": map_custom,
    "map_combine_append": map_combine_append,
    "map_combine_last": map_combine_last,
    "project_rules": project_rules,
    "route_index": route_index,
    "extender_tags": extender_tags,
    "analyze_text": analyze_text,
    "analyze_keyword": analyze_keyword,
    "analyze_per_index": analyze_per_index,
    "stored_view": stored_view,
    "term_query": term_query,
    "bool_must_query": bool_must_query,
    "match_query": match_query,
    "numeric_range": numeric_range,
    "index_counts": index_counts,
    "get_by_id": get_by_id,
    "facet_rows": facet_rows,
    "facet_counts": facet_counts,
    "facet_counts_filtered": facet_counts_filtered,
    "term_postings": term_postings,
    "index_table_roundtrip": index_table_roundtrip,
    "catalog_table_roundtrip": catalog_table_roundtrip,
    "term_query_stored": term_query_stored,
    "match_per_index": match_per_index,
    "reindex_incremental": reindex_incremental,
    "reindex_metrics": reindex_metrics,
    "term_query_index": term_query_index,
    "match_query_index": match_query_index,
    "term_postings_index": term_postings_index,
    "facet_counts_index": facet_counts_index,
    "collection_size_maintained": collection_size_maintained,
    "facet_counts_maintained": facet_counts_maintained,
    "facet_counts_filtered_index": facet_counts_filtered_index,
    "keyword_per_collection": keyword_per_collection,
    "stored_per_collection": stored_per_collection,
}
