"""Posting blocks from the token arrays of numbered documents, in Arrow and numpy inside tasks.

A task holds the documents of some batches, numbers their terms and sorts pairs of numbers, so each distinct term is handled as
text once, and what leaves the task are arrays of document numbers per term.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens and bytes that a task gathers before it writes blocks; one batch may have more.
TOKENS = 1 << 21
BYTES = 1 << 28
#: ``offsets`` are unsigned numbers of 16 bits; frequencies that do not fit 16 bits are in ``large``, for their whole block.
PIECES = ("index_name string, term string, block bigint, offsets array<smallint>, tfs array<smallint>, large array<int>, field string")


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values))


def _pieces(table: pa.Table, names: Sequence[str], bits: int) -> Iterator[pa.RecordBatch]:
    number = table.column("doc_no").to_numpy()
    index = pc.dictionary_encode(table.column("index_name").combine_chunks(), null_encoding="encode")
    code = index.indices.to_numpy()
    # Documents by index and number: those of one index and block follow each other.
    order = np.lexsort((number, code))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    number, code = number[order], code[order]
    block = number >> bits
    group = np.cumsum(np.r_[0, (np.diff(code) != 0) | (np.diff(block) != 0)])
    offset = (number & ((1 << bits) - 1)).astype(np.uint16).view(np.int16)
    for k, field in enumerate(names):
        tokens = table.column(f"tokens_{k}").combine_chunks()
        terms = tokens.flatten()
        rows = np.repeat(place, pc.fill_null(pc.list_value_length(tokens), 0).to_numpy())
        if terms.null_count:
            rows, terms = rows[terms.is_valid().to_numpy(zero_copy_only=False)], terms.drop_null()
        if not len(terms):
            continue
        terms = terms.dictionary_encode()
        found, tf = np.unique(terms.indices.to_numpy().astype(np.int64) * len(order) + rows, return_counts=True)
        term, at = np.divmod(found, len(order))
        starts = np.flatnonzero(np.r_[True, (np.diff(term) != 0) | (np.diff(group[at]) != 0)])
        edges = np.append(starts, len(found))
        small = np.maximum.reduceat(tf, starts) <= np.iinfo(np.int16).max
        short, long = (_lists(tf.astype(kind), edges) for kind in (np.int16, np.int32))
        out = [
            index.dictionary.take(pa.array(code[at[starts]])), terms.dictionary.take(pa.array(term[starts])),
            pa.array(block[at[starts]]), _lists(offset[at], edges), pc.if_else(pa.array(small), short, None),
            pc.if_else(pa.array(small), None, long), pa.array([field] * len(starts))]
        yield pa.RecordBatch.from_arrays(out, ["index_name", "term", "block", "offsets", "tfs", "large", "field"])


def block_pieces(names: Sequence[str], bits: int, tokens: int = TOKENS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: from rows ``doc_no, index_name, tokens_0, …`` (an array per name) to rows ``PIECES``.

    A row has the documents, of those a task holds at a time, with a term among ``2 ** bits`` numbers (16 bits at most).
    """
    names = list(names)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, size = [], 0, 0
        for batch in batches:
            more = sum(pc.sum(pc.list_value_length(batch.column(f"tokens_{k}"))).as_py() or 0 for k in range(len(names)))
            if held and (n + more > tokens or size + batch.nbytes > BYTES):
                yield from _pieces(pa.Table.from_batches(held), names, bits)
                held, n, size = [], 0, 0
            held, n, size = [*held, batch], n + more, size + batch.nbytes
        if sum(b.num_rows for b in held):
            yield from _pieces(pa.Table.from_batches(held), names, bits)

    return built
