"""Approximate nearest neighbours by inner product, over shifted Hilbert curves.

Each of several curves projects the vectors to a few dimensions, shifts the grid, and orders all vectors by
their place on a Hilbert curve. Spark sorts the places by range; ranks cut a curve into blocks of equal
numbers of vectors. A query looks at the blocks around its own place on every curve, and the windows' best
are merged and ranked by their true inner products.

Inner products become distances by one more coordinate, which gives all vectors the same length (and queries 0).
The width of the windows is not guessed: for a bounded sample of queries the true neighbours are computed from all
vectors, and the width is the least that reaches the target recall on them. Vectors without structure make
wide windows, clustered ones narrow windows. Equal vectors are one node with its smallest ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldex.functions.sizing import fits_broadcast
from foldex.llm.common import written

CURVES = 8
PROJECTED, BITS = 4, 12
#: A curve has so many blocks, or more where a block would hold more vectors than MAX_BLOCK.
BLOCKS = 16
MAX_BLOCK = 65_536
#: Vectors of a block at least: windows over fewer would save nothing.
LEAST_BLOCK = 128
#: Vectors from which projections are scaled, and queries from which the window is.
SCALE_SAMPLE = 4096
QUERY_SAMPLE = 256
TARGET = 0.95
#: Queries that meet a block in one task, and at once.
QUERIES, AT_ONCE = 4096, 128


@dataclass(frozen=True)
class Curve:
    """Projections, scales and shift of one curve."""

    axes: np.ndarray
    middle: np.ndarray
    spread: np.ndarray
    shift: np.ndarray

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        z = (vectors @ self.axes - self.middle) / self.spread
        even = 1 / (1 + np.exp(-np.clip(1.702 * z, -30, 30)))
        return hilbert(((even * 0.5 + self.shift) * (1 << BITS)).astype(np.int64), BITS)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with coordinates of ``bits`` bits, by rotating sub-cubes from the top bit down."""
    x = points.T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        side, low = 1 << bit, (1 << bit) - 1
        for i in range(dims):
            upper = (x[i] & side) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(upper, x[i], x[i] ^ swap)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        gray ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= gray
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> bit) & 1
    return key


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors from their bytes."""
    data = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(data.to_pylist()), np.float64).reshape(len(data), -1)


def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids, and bytes and dimensions of the vectors that are not null, zero, or without a number somewhere."""
    for batch in batches:
        vectors = batch.column("vector")
        clean = []
        for v in vectors:
            x = None if not v.is_valid or v.values.null_count else np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
            clean.append(None if x is None or not np.isfinite(x).all() or not x.any() else (x + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays([
            batch.column("vec_id"), pa.array(clean, pa.binary()),
            pa.array([None if c is None else len(c) // 8 for c in clean], pa.int32()),
            pa.array([None if c is None else float(np.linalg.norm(np.frombuffer(c))) for c in clean], pa.float64())], ["vec_id", "vec", "dims", "norm"]
        ).filter(pa.array([c is not None for c in clean], pa.bool_()))


def placed(curves: list[Curve], longest: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vectors' keys on every curve, as candidates and, where they are asked for, as queries."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("vec"))
            norm = np.linalg.norm(x, axis=1)
            rest = np.sqrt(np.maximum(0.0, longest**2 - norm**2))
            ask = np.flatnonzero(batch.column("ask").to_numpy(zero_copy_only=False))
            node = batch.column("node").to_numpy()
            roles = [(node, np.column_stack([x, rest]), False),
                     (node[ask], np.column_stack([x[ask] * (longest / norm[ask, None]), np.zeros(len(ask))]), True)]
            for names, points, query in roles:
                for c, curve in enumerate(curves):
                    if len(names):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([c] * len(names), pa.int32()), pa.array(curve.keys(points)), pa.array(names),
                            pa.array([query] * len(names))], ["curve", "key", "node", "query"])
    return run


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates of the same curve before each row of a sorted partition."""
    curve, before = None, 0
    for batch in batches:
        out = []
        for c, query in zip(batch.column("curve").to_pylist(), batch.column("query").to_pylist()):
            if c != curve:
                curve, before = c, 0
            out.append(before)
            before += not query
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, "before"])


def best(query: np.ndarray, names: np.ndarray, vectors: np.ndarray, node: np.ndarray, least_id: np.ndarray, top: int
         ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, node, score) of each query's ``top`` best vectors, by score and then by smallest id."""
    order = np.argsort(least_id, kind="stable")
    vectors, node = vectors[order], node[order]
    for start in range(0, len(query), AT_ONCE):
        score = query[start:start + AT_ONCE] @ vectors.T
        k = min(top, score.shape[1])
        limit = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        row, col = np.nonzero(score >= limit[:, None])
        value = score[row, col]
        rank = np.lexsort((col, -value, row))
        row, col, value = row[rank], col[rank], value[rank]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        yield names[start + row[place < k]], node[col[place < k]], value[place < k]


def triples(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table({"query": pa.array(parts[0], pa.int64()), "node": pa.array(parts[1], pa.int64()), "score": pa.array(parts[2], pa.float64())})


def scanned(query: np.ndarray, names: np.ndarray, top: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of each batch for a fixed set of queries."""
        for batch in batches:
            if batch.num_rows:
                node = batch.column("node").to_numpy()
                yield from triples(list(best(query, names, matrix(batch.column("vec")), node, node, top))).to_batches()
    return run


def searched(top: int) -> Callable:
    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        """The best of a block for the queries whose windows hold it."""
        if not queries.num_rows or not block.num_rows:
            return triples([])
        node = block.column("node").to_numpy()
        return triples(list(best(matrix(queries.column("asked")), queries.column("asker").to_numpy(),
                                 matrix(block.column("vec")), node, node, top)))
    return run


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` nodes per query; a pair that several windows found counts once."""
    pairs = found.groupBy("query", "node").agg(F.max("score").alias("score"))
    at = W.partitionBy("query").orderBy(F.col("score").desc(), "node")
    return pairs.withColumn("place", F.row_number().over(at)).where(F.col("place") <= top).drop("place")


def usable_rows(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, vec, dims, norm) of the rows that take part; ``row`` numbers them in the order of vec_id."""
    rows = embeddings.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where("vec_id is not null").mapInArrow(usable, "vec_id long, vec binary, dims int, norm double")
    ordered = rows.repartitionByRange("vec_id", "vec").sortWithinPartitions("vec_id", "vec")
    return written(ordered.withColumn("row", F.monotonically_increasing_id()), "vectors")


def distinct_vectors(rows: DataFrame, top: int, every: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, vec, ids: the first rows, ask: whether a query has this vector) and queries (query, query_id, node)."""
    smallest = rows.withColumn("nth", F.row_number().over(W.partitionBy("vec").orderBy("row"))).where(F.col("nth") <= top)
    heads = smallest.groupBy("vec").agg(F.array_sort(F.collect_list(F.struct("row", "vec_id"))).alias("ids"), F.max("norm").alias("norm"))
    asked = rows.where(F.col("vec_id") % every == 0)
    asking = asked.select("vec").distinct().withColumn("asked", F.lit(True))
    nodes = written(heads.join(asking, "vec", "left").select(
        F.col("ids")[0]["row"].alias("node"), "vec", "norm", "ids", F.coalesce("asked", F.lit(False)).alias("ask")), "nodes")
    names = written(nodes.where("ask").select("vec", "node"), "asked-nodes")
    queries = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "vec")
    return nodes, written(queries.join(names, "vec").select("query", "query_id", "node"), "queries")


def make_curves(nodes: DataFrame, longest: float, seed: int = 17) -> list[Curve]:
    """Curves whose scales come from at most SCALE_SAMPLE vectors."""
    some = matrix(nodes.orderBy(F.xxhash64("node")).limit(SCALE_SAMPLE).select("vec").toArrow().column("vec"))
    some = np.column_stack([some, np.sqrt(np.maximum(0.0, longest**2 - (some**2).sum(axis=1)))])
    rng, out = np.random.default_rng(seed), []
    for _ in range(CURVES):
        axes = rng.normal(size=(some.shape[1], PROJECTED))
        z = some @ axes
        out.append(Curve(axes, z.mean(axis=0), np.maximum(z.std(axis=0), 1e-12), rng.uniform(0, 0.5, PROJECTED)))
    return out


def positions(nodes: DataFrame, curves: list[Curve], longest: float, size: int, last: int) -> DataFrame:
    """(curve, node, query, block) for all candidates and queries."""
    keyed = nodes.select("node", "vec", "ask").mapInArrow(placed(curves, longest), "curve int, key long, node long, query boolean")
    order = ["curve", "key", "node", "query"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    local = written(ranged.drop("key").mapInArrow(counted, "curve int, node long, query boolean, part int, before long"), "curve-ranks")
    sizes = local.where("not query").groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = local.select("curve", "part").distinct().join(sizes, ["curve", "part"], "left")
    earlier = W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = written(parts.select("curve", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "curve-offsets")
    offsets = F.broadcast(offsets) if fits_broadcast(offsets) else offsets
    block = F.least(F.floor((F.col("before") + F.col("offset")) / size), F.lit(last)).cast("int")
    return written(local.join(offsets, ["curve", "part"]).select("curve", "node", "query", block.alias("block")), "blocks")


def window_width(nodes: DataFrame, places: DataFrame, top: int, target: float) -> int:
    """Blocks to either side that hold the target share of the sampled queries' true neighbours."""
    sample = nodes.where("ask").orderBy(F.xxhash64("node")).limit(QUERY_SAMPLE).select("node", "vec").toArrow()
    if not sample.num_rows:
        return 0
    names = sample.column("node").to_numpy()
    found = nodes.select("node", "vec").mapInArrow(scanned(matrix(sample.column("vec")), names, top), "query long, node long, score double")
    true = written(ranked(found, top).select("query", "node"), "true-neighbours")
    # At most QUERY_SAMPLE times ``top`` pairs.
    theirs = places.where("not query").drop("query").join(F.broadcast(true), "node").select("query", "node", "curve", F.col("block").alias("there"))
    own = places.where(F.col("query") & F.col("node").isin([int(n) for n in names])).select(F.col("node").alias("asker"), F.col("curve").alias("on"), "block")
    apart = theirs.join(F.broadcast(own), (F.col("query") == F.col("asker")) & (F.col("curve") == F.col("on"))).groupBy("query", "node").agg(
        F.min(F.abs(F.col("block") - F.col("there"))).alias("apart"))
    reached = 0
    counts = sorted(apart.groupBy("apart").count().collect())
    total = sum(r["count"] for r in counts)
    for r in counts:
        reached += r["count"]
        if reached >= target * total:
            return r.apart
    return 0


def nearest(embeddings: DataFrame, top: int = 20, every: int = 20, target: float = TARGET) -> DataFrame:
    """For each vec_id divisible by ``every``: query_id, rank, vec_id and score of its ``top`` nearest found.

    Nearness is the inner product in double precision, ties go to the smaller vec_id, a row is not its own neighbour.
    Vectors that are null, empty, zero, or hold a null or a non-finite number take no part, nor do rows without
    vec_id. Vectors of each length are searched by themselves, one length after another. Rows that share a vec_id are
    queries and candidates each. An empty table gives no rows.
    """
    rows = usable_rows(embeddings)
    lengths = sorted(r.dims for r in rows.select("dims").distinct().collect())  # at most one row per length
    if not lengths:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.col("norm").alias("score"))
    return reduce(DataFrame.unionByName, [nearest_of_length(rows.where(F.col("dims") == n), top, every, target) for n in lengths])


def nearest_of_length(rows: DataFrame, top: int, every: int, target: float) -> DataFrame:
    nodes, queries = distinct_vectors(rows, top + 1, every)
    longest, total = nodes.agg(F.max("norm"), F.count(F.lit(1))).first()
    size = min(MAX_BLOCK, max(LEAST_BLOCK, -(-total // BLOCKS)))
    last = (total - 1) // size
    places = positions(nodes, make_curves(nodes, longest), longest, size, last)
    width = window_width(nodes, places, top, target)

    asked = places.where("query")
    # One row per block of a curve.
    load = asked.select("curve", "node", F.explode(F.sequence(
        F.greatest(F.col("block") - width, F.lit(0)), F.least(F.col("block") + width, F.lit(last)))).alias("block"))
    copies = written(load.groupBy("curve", "block").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("copies")), "block-copies")
    copies = F.broadcast(copies) if fits_broadcast(copies) else copies
    asking = nodes.select(F.col("node").alias("asker"), F.col("vec").alias("asked"))
    windows = load.join(copies, ["curve", "block"]).join(asking, F.col("node") == F.col("asker")).select(
        F.col("curve").alias("on"), F.col("block").alias("in"), F.pmod(F.xxhash64("asker"), "copies").cast("int").alias("part"), "asker", "asked")
    each = copies.select("curve", "block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    blocks = places.where("not query").select("curve", "block", "node").join(each, ["curve", "block"]).join(
        nodes.select("node", "vec"), "node").select("curve", "block", "copy", "node", "vec")
    found = windows.groupBy("on", "in", "part").cogroup(blocks.groupBy("curve", "block", "copy")).applyInArrow(
        searched(top + 1), "query long, node long, score double")

    # Each query's nodes spread to their first rows, its own left out.
    near = written(ranked(found, top + 1), "near")
    ids = near.join(nodes.select("node", "ids"), "node").select(F.col("query").alias("asker"), "score", F.inline("ids"))
    at = W.partitionBy("asker").orderBy(F.col("score").desc(), "row")
    lists = ids.withColumn("nth", F.row_number().over(at)).where(F.col("nth") <= top + 1).groupBy("asker").agg(
        F.array_sort(F.collect_list(F.struct("nth", "row", "vec_id", "score"))).alias("list"))
    mine = queries.join(written(lists, "lists"), F.col("node") == F.col("asker"))
    others = F.slice(F.filter("list", lambda x: x["row"] != F.col("query")), 1, top)
    return mine.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score")
