"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare
from workload import change_queries, mapping_queries


def test_index_queries_have_sql():
    """Only some of the training-data queries (which may be absent) are beyond SQL."""
    assert set(change_queries.QUERIES) | set(mapping_queries.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", entry.queries())
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, name) is None


def test_strict_types_nested_of_quotes_and_escapes(spark, folder):
    """Only whole sentences without quotes and backslashes become numbers; no document is broken by it."""
    long = "x" * 149
    texts = [f'{long}xx" y.', f"{long}\\x.", f'{long}xx "', f"{long}.", f"{long}\t.", f"{long}\u0001.", "\t" * 150, f"{long}é.a", f"{long}😀",
             f'short. {long}yy.said "so"', f'"body":"{long}z', "", None, "y" * 100_000]
    path = folder("sf")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    found = mapping_queries.strict_types_nested(spark, path).collect()
    assert {r.reason for r in found} == {"type_mismatch"}
    sentences = [[s for line in (t or "").split("\n") for s in line.split(".")] for t in texts]
    want = {i for i, ss in enumerate(sentences) if any(len(s) >= 150 and '"' not in s and "\\" not in s for s in ss)}
    assert {int(r.uid) for r in found} == want and len(want) == 7
