"""Read surface over index documents: counts, lookups, predicates, facets and postings.

The index is an ordinary DataFrame; ``IndexView`` only knows which fields are analysed, stored
or facet dimensions. Predicates are columns, combined with ``&`` and ``|``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldex.functions.analysis import Analyzer
from foldex.functions.sizing import fits_broadcast
from foldex.model import EXT, IndexConfig

METADATA = ("index_name", "_id", "_collection", "_database")


def all_of(*conditions: Column) -> Column:
    """Every condition must hold; no condition matches everything."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def match_all() -> Column:
    return F.lit(True)


def _labelled(dimension: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(dimension).alias("dim"), v.alias("value")))


def _by_index(config: IndexConfig, value: Callable[[Analyzer], Column]) -> Column:
    """A value that depends on the analyser of a document's index."""
    chain = None
    for index, analyzer in config.analyzers.items():
        hit = F.col("index_name") == index
        chain = F.when(hit, value(analyzer)) if chain is None else chain.when(hit, value(analyzer))
    default = value(config.analyzer)
    return default if chain is None else chain.otherwise(default)


def _tokens(field: str, multi: bool, config: IndexConfig, collection: str) -> Column:
    """Token array of a field, whether it is text or a keyword in a document's collection."""
    exact = F.col(field) if multi else F.array_compact(F.array(F.col(field)))
    text = config.text_collections(field)
    if not text:
        return exact

    def analysed(analyzer: Analyzer) -> Column:
        chosen = analyzer.for_field(field)
        if not multi:
            return chosen.tokens(F.col(field))
        return F.flatten(F.transform(F.array_compact(F.col(field)), chosen.tokens))

    words = _by_index(config, analysed)
    if set(text) == set(config.collections_where(field, lambda r: True)):
        return words
    return F.when(F.col(collection).isin(text), words).otherwise(exact.cast("array<string>"))


def with_tokens(rows: DataFrame, config: IndexConfig) -> DataFrame:
    """Index rows with ``<field>_tokens`` for their text fields, so that reading need not analyse again."""
    found = [f for f in config.text_fields() if f in rows.columns]
    multi = {f: isinstance(rows.schema[f].dataType, T.ArrayType) for f in found}
    return rows.withColumns({f"{f}_tokens": _tokens(f, multi[f], config, "collection") for f in found})


class IndexView:
    """Index documents plus the configuration they were built with."""

    def __init__(self, documents: DataFrame, config: IndexConfig):
        self.documents = documents
        self.config = config

    def where(self, condition: Column) -> IndexView:
        return IndexView(self.documents.where(condition), self.config)

    # -- counts and lookups ---------------------------------------------------------------

    def size(self, database: str, collection: str) -> int:
        """Number of documents of one collection."""
        mine = all_of(F.col("_database") == database, F.col("_collection") == collection)
        return self.documents.where(mine).count()

    def sizes(self) -> DataFrame:
        """Number of documents of every collection."""
        return self.documents.groupBy("_database", "_collection").agg(F.count(F.lit(1)).alias("n"))

    def index_counts(self) -> DataFrame:
        """Number of documents of every index, across collections."""
        return self.documents.groupBy("index_name").agg(F.count(F.lit(1)).alias("n"))

    def get(self, uid: str) -> DataFrame:
        return self.documents.where(F.col("_id") == uid)

    def get_many(self, ids: DataFrame, column: str = "_id") -> DataFrame:
        """Documents whose id is in ``ids``; a small id list is broadcast after a size check."""
        wanted = ids.select(F.col(column).alias("_id")).distinct()
        if fits_broadcast(wanted):
            wanted = F.broadcast(wanted)
        return self.documents.join(wanted, "_id", "left_semi")

    def stored(self) -> DataFrame:
        """What a reader can get back: metadata and the fields marked as stored, per collection."""
        def value(field: str) -> Column:
            own = self.config.collections_where(field, lambda r: r.stored)
            has = self.config.collections_where(field, lambda r: True)
            return F.col(field) if set(own) == set(has) else F.when(F.col("_collection").isin(own), F.col(field)).alias(field)

        return self.documents.select(*METADATA, *[value(f) for f in self.config.stored_fields()])

    # -- text -------------------------------------------------------------------------------

    def _multi(self, field: str) -> bool:
        return isinstance(self.documents.schema[field].dataType, T.ArrayType)

    def tokens(self, field: str) -> Column:
        """Token array of a field: analysed text per index analyser, exact values for keywords.

        A column written with the index is used where there is one.
        """
        if f"{field}_tokens" in self.documents.columns:
            return F.col(f"{field}_tokens")
        return _tokens(field, self._multi(field), self.config, "_collection")

    def analysed(self, *fields: str) -> DataFrame:
        """Adds a ``<field>_tokens`` array per field."""
        return self.documents.withColumns({f"{f}_tokens": self.tokens(f) for f in fields})

    # -- predicates -------------------------------------------------------------------------

    def term(self, field: str, value) -> Column:
        """Exact term: equality on single values, membership on lists and analysed text."""
        if field in METADATA or not (self.config.is_text(field) or self._multi(field)):
            return F.col(field) == F.lit(value)
        return F.array_contains(self.tokens(field), F.lit(value))

    def match(self, field: str, text: str, index: str | None = None) -> Column:
        """Analysed match: at least one token of ``text`` occurs in the field.

        The text is analysed as the field is, index by index, or as in ``index`` if given. It is a literal,
        so the optimiser folds its tokens to constants.
        """
        def hit(analyzer: Analyzer) -> Column:
            return F.arrays_overlap(self.tokens(field), analyzer.for_field(field).tokens(F.lit(text)))

        if index is not None:
            return hit(self.config.analyzers.get(index, self.config.analyzer))
        return _by_index(self.config, hit)

    def between(self, field: str, low, high) -> Column:
        """Inclusive range on a typed field; on a written index the comparison is pushed to the scan."""
        if not self._multi(field):
            return F.col(field).between(low, high)
        return F.exists(field, lambda v: v.between(low, high))

    # -- facets -----------------------------------------------------------------------------

    def _dimension(self, name: str) -> Column:
        """Distinct values of a facet dimension of one document, as an array of text."""
        if name in self.documents.columns:
            column = F.col(name)
            values = column.cast("array<string>") if self._multi(name) else F.array(column.cast("string"))
        else:
            values = F.col(EXT)[name]
        return F.array_distinct(F.array_compact(values))

    def facet_values(self) -> list[tuple[str, Column]]:
        """The facet dimensions, each with a document's distinct values; null where its index does not show the dimension."""
        per_index = self.config.facets_by_index
        names = list(dict.fromkeys([*self.config.facets, *[d for ds in per_index.values() for d in ds]]))
        found = []
        for name in names:
            shown_in = [i for i, ds in per_index.items() if name in ds]
            own = F.col("index_name").isin(shown_in)
            if name in self.config.facets:
                own = own | ~F.col("index_name").isin(list(per_index))
            found.append((name, F.when(own, self._dimension(name)) if per_index else self._dimension(name)))
        return found

    def facet_rows(self, carry: Sequence[str] = METADATA) -> DataFrame:
        """One row per document, facet dimension and distinct value; ``carry`` are the columns that name a document."""
        pairs = [_labelled(name, F.coalesce(values, F.array().cast("array<string>"))) for name, values in self.facet_values()]
        rows = self.documents.select(*carry, F.explode(F.concat(*pairs)).alias("_f"))
        return rows.select(*carry, "_f.dim", "_f.value")

    def facets(self, condition: Column | None = None) -> DataFrame:
        """Documents per facet value, optionally only among the hits of a condition.

        Keys are unique in an index and values are distinct per document, so a plain count is the
        number of documents and combines on the map side.
        """
        hits = self if condition is None else self.where(condition)
        return hits.facet_rows().groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n"))

    # -- postings -----------------------------------------------------------------------------

    def postings(self, field: str, carry: Sequence[str] = METADATA) -> DataFrame:
        """Term → document with term frequency, computed inside each document without a shuffle.

        The tokens of one document are sorted and the lengths of equal runs counted, so nothing
        but finished postings leaves a task. ``carry`` are the columns that name a document.
        """
        # sort_array and an outer explode keep the optimiser from computing the tokens twice.
        words = self.documents.select(*carry, F.sort_array(self.tokens(field)).alias("_w"))
        positions = F.when(F.size("_w") > 0, F.sequence(F.lit(1), F.size("_w")))
        starts = F.filter(positions, lambda i: (i == 1) | (F.col("_w")[i - 1] != F.col("_w")[i - 2]))
        runs = words.withColumn("_s", starts)
        ends = F.concat(F.slice(F.col("_s"), 2, F.size("_s")), F.array(F.size("_w") + 1))
        entries = F.zip_with(
            "_s", ends,
            lambda s, e: F.struct(F.col("_w")[s - 1].alias("term"), (e - s).cast("bigint").alias("tf")),
        )
        rows = runs.select(*carry, F.explode_outer(entries).alias("_p"))
        postings = rows.select(F.col("_p.term").alias("term"), *carry, F.col("_p.tf").alias("tf"))
        return postings.where(F.col("term").isNotNull())
