"""Plan shapes that keep the work scalable: no needless shuffle, pruned scans, partial aggregation."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex import ApplyPolicy, FieldRule, IndexConfig, apply_changes, fold_keys, index_documents, project
from foldex.functions import mappers as m
from foldex.sources.snapshot import snapshot
from workload import change_queries, derive, mapping_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.mark.parametrize("name", ["project_rules", "analyze_text", "map_list_path_deep", "term_postings", "stored_view",
                                  "facet_rows", "term_query"])
def test_document_operators_do_not_shuffle(spark, sf_dir, name):
    text = plan(mapping_queries.QUERIES[name](spark, sf_dir))
    spread = text.count("REPARTITION_BY_NUM")  # small inputs are spread over the cores first
    assert text.count("Exchange") == spread
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_ranges_reach_the_scan_of_the_documents(spark, sf_dir):
    text = plan(mapping_queries.QUERIES["numeric_range"](spark, sf_dir))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text)[1]
    assert "GreaterThanOrEqual(n_chars,500)" in pushed and "LessThanOrEqual(n_chars,5000)" in pushed and "CASE" not in text


def test_projection_of_ruled_collections_only(spark, sf_dir):
    docs = derive.text_documents(spark, sf_dir)
    config = IndexConfig(rules={"de": (FieldRule("n_chars", "n_chars", m.to_long), FieldRule("lang", "source", m.to_string)),
                                "en": (FieldRule("n_chars", "n_chars", m.to_long),)})
    some, every = (index_documents(project(docs, config, ruled_only=only)) for only in (True, False))
    columns = ["_id", "_collection", "n_chars", "source"]
    wanted = every.where(F.col("_collection").isin("de", "en")).select(columns).collect()
    assert sorted(some.select(columns).collect()) == sorted(wanted) and 0 < len(wanted) < every.count()


def test_rebuild_does_not_shuffle(spark, sf_dir):
    text = plan(change_queries.reindex_collections(spark, sf_dir))
    assert text.count("Exchange") == text.count("REPARTITION_BY_NUM")


def test_fold_shuffles_once_after_projection(spark, sf_dir):
    df = change_queries.cdc_full_replay(spark, sf_dir)
    assert shuffles(df) == 1
    assert "row_number(), 1, Partial" in plan(df) and "CartesianProduct" not in plan(df)
    assert "BroadcastNestedLoopJoin" not in plan(df)
    merged = change_queries.cdc_update_merge(spark, sf_dir)
    assert shuffles(merged) == 1 and "partial_max_by" in plan(merged)


def test_live_keys_use_hash_aggregation_over_key_columns(spark, sf_dir):
    df = change_queries.collection_size(spark, sf_dir)
    assert "SortAggregate" not in plan(df) and "props" not in plan(df)


def test_scan_reads_only_the_nested_fields_of_the_rules(spark, sf_dir, folder):
    path = folder("outline")
    derive.outline_documents(spark, sf_dir).write.parquet(path)
    stored = spark.read.parquet(path)
    config = IndexConfig(rules={"en": [
        FieldRule("paragraphs.opening", "o", m.to_string_list), FieldRule("origin.name", "n", m.to_string)]})
    df = index_documents(project(stored, config)).drop("uid")
    schema = re.search(r"ReadSchema: (\S+)", df._jdf.queryExecution().executedPlan().toString()).group(1)
    assert "opening" in schema and "name" in schema
    assert "sentences" not in schema and "clauses" not in schema and "lines" not in schema


def test_small_base_delta_leaves_the_base_unshuffled(spark):
    base = spark.range(1000).select(
        F.col("id").cast("string").alias("uid"), F.lit("c").alias("collection"), F.lit("d").alias("database"),
        F.lit("c").alias("index_name"), F.lit(-1).cast("bigint").alias("seq"), F.col("id").alias("value"))
    events = base.where("value < 10").select(
        F.lit(5).cast("bigint").alias("seq"), F.lit("insert").alias("op"), "database", "collection", "uid",
        (F.col("value") + 1).alias("value"))
    df = apply_changes(events, ApplyPolicy(), base=base)
    assert shuffles(df) <= 2 and "BroadcastHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)
    assert df.count() == 1000 and df.agg(F.sum("value")).first()[0] == 999 * 500 + 10


def test_filters_reach_the_scan(spark, folder):
    path = folder("index")
    spark.range(100).select(F.col("id").alias("_id"), F.lit("c").alias("_collection"),
                            F.lit("d").alias("_database"), F.lit("c").alias("index_name"),
                            F.col("id").alias("n")).write.parquet(path)
    from foldex import IndexView, all_of
    view = IndexView(spark.read.parquet(path), IndexConfig(rules={"c": [FieldRule("n", "n", m.to_long)]}))
    text = plan(view.where(all_of(view.term("_collection", "c"), view.between("n", 5, 9))).documents)
    assert "GreaterThanOrEqual(n,5)" in text and "EqualTo(_collection,c)" in text


def test_pandas_udf_as_custom_mapper(spark):
    import pandas as pd

    @F.pandas_udf("string")
    def backwards(values: pd.Series) -> pd.Series:
        return values.str[::-1]

    mapper = m.custom(lambda path, doc: backwards(doc.getField(path)), T.StringType())
    table = spark.createDataFrame([("abc",)], "name string")
    docs = snapshot(table, "d", "c", F.lit("1"))
    config = IndexConfig(rules={"c": [FieldRule("name", "name", mapper)]})
    assert project(docs, config).first().name == "cba"


def test_fold_keys_matches_fold(spark, sf_dir):
    events = change_queries.feed(spark, sf_dir)
    rows = project(events, change_queries.EVENT_CONFIG).drop("index_name")
    policy = ApplyPolicy(update="merge")
    keys = fold_keys(events, policy).select("database", "collection", "uid")
    full = apply_changes(rows, policy).select("database", "collection", "uid")
    assert keys.exceptAll(full).count() == 0 and full.exceptAll(keys).count() == 0
