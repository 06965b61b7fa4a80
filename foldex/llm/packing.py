"""Packing documents into training sequences by bin completion.

Documents are cut into pieces of one sequence's capacity; a last piece may be shorter. Full pieces
are sequences of their own. Short pieces are dealt at random to groups of bounded size, and each
group is packed by branch and bound: take the largest piece left, enumerate the undominated ways to
fill the rest of its sequence, try them from the fullest on, and give a branch up when the waste so
far proves that it cannot beat the incumbent. The first incumbent is best fit decreasing. A search
ends early when it meets a lower bound, and gives up after a documented number of nodes; its incumbent is a complete packing in any case. Independent groups cost at most one
sequence each, one in some thousands.
"""

from __future__ import annotations

import bisect
import itertools
import os
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldex.llm.common import slices, utf8, written

CAPACITY = 2048
#: Short pieces to a group, fillings that the search of a group looks at (its first descent always ends), and those looked
#: at for a sequence before the fullest is tried.
GROUP = 8192
NODES = 20_000
LOOK = 300
#: Words whose ids a task keeps, and bytes of text worked on at once.
CACHE = 1_000_000
TEXT = 4 << 20


# --- search ------------------------------------------------------------------------------------

def best_fit(sizes: Counter, capacity: int) -> list[list[int]]:
    """Bins by best fit decreasing."""
    room: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for size in sorted(sizes.elements(), reverse=True):
        at = bisect.bisect_left(room, (size, -1))
        if at == len(room):
            bins.append([])
            left, number = capacity, len(bins) - 1
        else:
            left, number = room.pop(at)
        bins[number].append(size)
        if left > size:
            bisect.insort(room, (left - size, number))
    return bins


class Sizes:
    """A multiset of sizes that finds the largest one up to a limit."""

    def __init__(self, sizes: Counter):
        self.counts = Counter(sizes)
        self.present = sum(1 << s for s in self.counts)
        self.total = sum(s * n for s, n in self.counts.items())

    def largest(self, limit: int) -> int:
        """0 if there is none."""
        return max(0, (self.present & ((1 << (limit + 1)) - 1)).bit_length() - 1) if limit > 0 else 0

    def take(self, size: int) -> None:
        self.counts[size] -= 1
        self.total -= size
        if not self.counts[size]:
            del self.counts[size]
            self.present ^= 1 << size

    def give(self, size: int) -> None:
        if size not in self.counts:
            self.present |= 1 << size
        self.counts[size] += 1
        self.total += size


def dominated(filling: list[int], slack: int, free: Callable[[int], int]) -> bool:
    """Whether one piece that is not in the filling could stand for one or two of its pieces and hold more."""
    if not slack:
        return False
    for i, x in enumerate(filling):
        if free(x + slack) > x:
            return True
        if any(free(x + y + slack) > x + y for y in filling[i + 1:i + 2]):
            return True
    return False


def fillings(sizes: Sizes, room: int) -> Iterator[tuple[int, ...] | None]:
    """Ways to fill ``room`` with any number of pieces, depth first, larger pieces first; None for a dominated one.

    ``sizes`` may change while the iterator rests, if it is as before when the iterator goes on.
    """
    used: list[int] = []
    taken: Counter = Counter()
    left = limit = room

    def free(most: int) -> int:
        size = sizes.largest(most)
        while size and taken[size] >= sizes.counts[size]:
            size = sizes.largest(size - 1)
        return size

    while True:
        while size := free(min(left, limit)):
            used.append(size)
            taken[size] += 1
            left, limit = left - size, size
        yield None if dominated(used, left, free) else tuple(used)
        while used:
            size = used.pop()
            taken[size] -= 1
            left, limit = left + size, size - 1
            if free(limit):
                break
        else:
            return


def completions(sizes: Sizes, room: int, spent: list[int]) -> Iterator[tuple[int, ...]]:
    """The undominated fillings of ``room``: the fullest of the first ``LOOK`` ones first, the others as they come."""
    if sizes.largest(room) == room:
        spent[0] += 1
        return iter([(room,)])  # one piece that fills the room dominates every other filling
    every = fillings(sizes, room)

    def counted() -> Iterator[tuple[int, ...]]:
        for filling in every:
            spent[0] += 1
            if filling is not None:
                yield filling

    found = []
    for filling in itertools.islice(every, LOOK):
        spent[0] += 1
        if filling is not None:
            found.append(filling)
            if sum(filling) == room:
                break
    return itertools.chain(sorted(found, key=sum, reverse=True), counted())


def lower_bound(sizes: Counter, capacity: int) -> int:
    """Bins that any packing needs: pieces over half a bin stand alone, and pieces of at least ``small`` share
    only what bins of pieces up to ``capacity - small`` leave; the best of all choices of ``small``."""
    count = np.zeros(capacity + 2, np.int64)
    for size, n in sizes.items():
        count[size] = n
    number, total = np.cumsum(count), np.cumsum(count * np.arange(capacity + 2))
    half = capacity // 2
    small = np.arange(half + 1)
    big = number[-1] - number[half]
    gaps = (number[capacity - small] - number[half]) * capacity - (total[capacity - small] - total[half])
    rest = total[half] - np.where(small > 0, total[small - 1], 0) - gaps
    return int(big + np.maximum(0, -(-rest // capacity)).max())


def bin_completion(sizes: Counter, capacity: int, nodes: int = NODES) -> list[list[int]]:
    """Bins for a multiset of sizes, each at most ``capacity``."""
    best = best_fit(sizes, capacity)
    least = lower_bound(sizes, capacity)
    left = Sizes(sizes)
    bins: list[list[int]] = []
    #: For every open bin the fillings that are still to be tried.
    choices: list[Iterator[tuple[int, ...]]] = []
    spent, first_pass = [0], True
    while len(best) > least:
        if left.total and len(bins) + -(-left.total // capacity) < len(best):
            first = left.largest(capacity)
            left.take(first)
            bins.append([first])
            choices.append(completions(left, capacity - first, spent))
        else:
            first_pass = False
            if not left.total and len(bins) < len(best):
                best = [list(b) for b in bins]
                continue
            for size in bins[-1][1:]:
                left.give(size)
            del bins[-1][1:]
        if spent[0] > nodes and not first_pass:
            break
        while bins and (filling := next(choices[-1], None)) is None:
            choices.pop()
            left.give(bins.pop()[0])
            if bins:
                for size in bins[-1][1:]:
                    left.give(size)
                del bins[-1][1:]
        if not bins:
            break
        for size in filling:
            left.take(size)
            bins[-1].append(size)
    return best


# --- tokens ------------------------------------------------------------------------------------

#: Kinds of bytes: spaces, letters, digits, marks, apostrophes, ends of texts, bytes beyond ASCII.
SPACE, LETTER, DIGIT, MARK, APOSTROPHE, END, BEYOND = range(7)


def byte_kinds(apart: bool) -> bytes:
    """The kind of every byte; if words are not to come ``apart``, all but spaces and ends are as beyond ASCII, where nothing is cut."""
    kinds = np.full(256, BEYOND, np.uint8)
    if apart:
        kinds[:128] = MARK
        kinds[48:58], kinds[65:91], kinds[97:123], kinds[39] = DIGIT, LETTER, LETTER, APOSTROPHE
    kinds[32], kinds[10] = SPACE, END
    return kinds.tobytes()


def cut_pairs() -> bytes:
    """1 where a word starts at a byte, by 8 times the kind of the byte before and its own.

    The tokenizer never joins letters, digits and marks, and keeps digits apart. It may join a byte beyond ASCII with any
    neighbour but a digit behind it, and an apostrophe with marks or the letters behind it. Normalising never
    joins an ASCII character with what stands before it.
    """
    cuts = np.zeros((32, 8), np.uint8)
    cuts[[SPACE, END], 1:] = cuts[:, END] = 1
    cuts[[LETTER, DIGIT, MARK, BEYOND], DIGIT] = cuts[[LETTER, DIGIT], MARK] = cuts[[DIGIT, MARK], LETTER] = 1
    return cuts.tobytes()


KINDS, CUTS = {apart: byte_kinds(apart) for apart in (False, True)}, cut_pairs()


def cut_words(text: bytes, apart: bool) -> pa.Array:
    """The words of texts that each end with a line end, a word by itself. If they are to come ``apart``, their letters,
    digits and marks are words."""
    kinds = np.frombuffer(bytearray(text.translate(KINDS[apart])), np.uint8)
    data = np.frombuffer(text, np.uint8)
    if apart:
        # U+00C0 to U+027F are letters, but for two signs; lower-cased, U+0130 is a letter and a mark.
        at = np.flatnonzero(data - np.uint8(0xC3) <= 6)
        first, second = data[at], data[at + 1]
        sure = (second & 0xC0) == 0x80
        for character in "\u00d7\u00f7\u0130":
            lead, rest = character.encode()
            sure &= (first != lead) | (second != rest)
        kinds[at[sure] + 1] = LETTER
    word = kinds != SPACE
    pairs = kinds.copy()
    pairs[1:] |= kinds[:-1] << 3
    start = np.flatnonzero(np.frombuffer(pairs.tobytes().translate(CUTS), bool))
    inside = np.cumsum(word, dtype=np.int32)
    edges = np.append(inside[start] - 1, inside[-1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(edges), pa.py_buffer(data[word])])


def lowered(text: bytes) -> bytes:
    """A to Z lower-cased where that comes to the same before and after normalising: not before a character beyond ASCII,
    which may be a mark that makes another letter of both."""
    data = np.frombuffer(text, np.uint8)
    after = np.append(data[1:], np.uint8(0))
    return (data + 32 * ((data >= 65) & (data <= 90) & (after < 128)).astype(np.uint8)).tobytes()


class WordIds:
    """The ids of words, encoded one by one: letters, digits and marks, which the tokenizer never joins; each is encoded once.

    ``flat`` holds the ids of all known words, ``starts`` and ``lengths`` tell where a word's are. Place 0 is the end of a
    document, an id of 0.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        #: Whether an id ends a word of letters; none is known to if some byte at a word's end would have no id.
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix and all(byte + suffix in vocabulary for byte in ByteLevel.alphabet()):
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {b"\n": 0}
        self.flat, self.starts, self.lengths = np.zeros(1, "<u4"), np.zeros(1, np.int64), np.ones(1, np.int64)
        #: Calls that used a word since words were last dropped.
        self.uses = np.zeros(1, np.int32)

    def drop_rare(self) -> None:
        """Drops the words used once only since the last time, or all if that leaves many."""
        keep = self.uses > 1
        keep[0] = True
        if keep.sum() > CACHE // 2:
            return self.clear()
        words = list(itertools.compress(self.places, keep.tolist()))
        self.places = {}
        self.places.update(zip(words, itertools.count()))
        self.flat, self.lengths = self.flat[np.repeat(keep, self.lengths)], self.lengths[keep]
        self.starts, self.uses = np.cumsum(self.lengths) - self.lengths, np.zeros(len(words), np.int32)

    def _encode(self, words: list[bytes]) -> tuple[list[np.ndarray], list[int]]:
        """The ids of some words, each encoded by itself, and how many each has."""
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        ids = [np.array(e.ids, "<u4") for e in encoded]
        return ids, [len(i) for i in ids]

    def _encode_letters(self, words: list[bytes]) -> tuple[list[np.ndarray], list[int] | np.ndarray]:
        """The same for words of letters. Almost all are one piece of a text each, whose last id tells, so a text of many is
        encoded at once. As every word has an id that ends a piece, as many such ids as words mean that all are."""
        text = b" ".join(words).decode("utf-8", "replace")
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        last = np.flatnonzero(self.last[ids])
        return ([ids], np.diff(last, prepend=-1)) if len(last) == len(words) else self._encode(words)

    def learn(self, new: list[bytes]) -> None:
        letters, others = [], []
        for w in new:
            (letters if w.isalpha() or not w.isascii() and w.decode("utf-8", "replace").isalpha() else others).append(w)
        flat, lengths = [self.flat], [self.lengths]
        for words, encode in ((letters, self._encode_letters), (others, self._encode)):
            for start in range(0, len(words), 2_000):
                ids, sizes = encode(words[start:start + 2_000])
                flat.extend(ids)
                lengths.append(np.asarray(sizes, np.int64))
        self.places.update(zip(itertools.chain(letters, others), itertools.count(len(self.starts))))
        self.flat, self.lengths = np.concatenate(flat), np.concatenate(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.uses = np.append(self.uses, np.zeros(len(new), np.int32))

    def find(self, words: np.ndarray) -> np.ndarray:
        """Where the words' ids are; -1 for unknown words."""
        return np.fromiter(map(self.places.get, words.tolist(), itertools.repeat(-1)), np.int64, len(words))

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with a 0 behind, and where each ends."""
        whole = b"".join(t.replace(b"\n", b" ") + b"\n" for t in texts)
        # Lower-casing beforehand makes fewer words; special tokens are left as they stand.
        plain = b"<|" not in whole
        coded = cut_words(lowered(whole) if plain else whole, plain).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        own = self.find(distinct)
        if (own < 0).any():
            if len(self.places) + (own < 0).sum() > CACHE:
                self.drop_rare()
                own = self.find(distinct)
            new = own < 0
            self.learn(distinct[new].tolist())
            own[new] = self.find(distinct[new])
        self.uses[own] += 1
        at = own[coded.indices.to_numpy()]
        lengths = self.lengths[at]
        after = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[at] - after + lengths, lengths) + np.arange(after[-1])]
        return ids, after[at == 0]


#: A worker's word ids, by tokenizer file.
LOADED: dict[str, WordIds] = {}


def piece_rows(path: str, capacity: int, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per piece of a document's ids and the closing 0."""
        if path not in LOADED:
            LOADED[path] = WordIds(path)
        words = LOADED[path]
        for batch in slices(batches, "text", TEXT):
            texts = [t or b"" for t in utf8(batch.column("text"))]
            ids, ends = words.of(texts)
            starts = np.append(0, ends[:-1])
            pieces = -(-(ends - starts) // capacity)
            at = np.repeat(np.arange(len(texts)), pieces)
            number = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = starts[at] + number * capacity
            end = np.minimum(begin + capacity, ends[at])
            data = memoryview(ids).cast("B")
            parts = [data[4 * i:4 * k] for i, k in zip(begin.tolist(), end.tolist())]
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(at)), "piece": pa.array(number, pa.int32()),
                "start": pa.array(number * capacity, pa.int64()), "length": pa.array(end - begin, pa.int64()),
                "ids_crc32": pa.array(map(zlib.crc32, parts), pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array([bytes(p) for p in parts], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)
    return run


# --- Spark -------------------------------------------------------------------------------------

def pack_group(capacity: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Sequence and offset of every piece of a group."""
        sizes, rows = table.column("length").to_pylist(), table.column("row").to_pylist()
        of_size = defaultdict(list)
        for size, row in sorted(zip(sizes, rows), reverse=True):
            of_size[size].append(row)
        out = []
        first = table.column("group")[0].as_py() * 2**24
        for number, sequence in enumerate(bin_completion(Counter(sizes), capacity), first):
            offset = 0
            for size in sequence:
                out.append((of_size[size].pop(), number, offset))
                offset += size
        row, sequence, offset = map(list, zip(*out))
        return pa.table({"row": pa.array(row, pa.int64()), "sequence_id": pa.array(sequence, pa.int64()),
                         "offset": pa.array(offset, pa.int64())})
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset, and its ``ids`` if asked for.

    A document is its text's ids (null text: none) and a 0, so an empty one is a piece of one id.
    ``tokenizer`` is the path, on every executor, of a tokenizer that lower-cases, drops white space and never joins letters,
    digits and marks. Repeated rows are
    packed each. An empty table gives no pieces. Sequences of full pieces have negative numbers.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint"), "text")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    pieces = narrow.mapInArrow(piece_rows(tokenizer, capacity, keep_ids), schema)
    pieces = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == capacity
    short = pieces.where(~full).select("row", "length")
    groups = max(1, round(short.count() / GROUP))
    placed = short.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups))).groupBy("group").applyInArrow(
        pack_group(capacity), "row long, sequence_id long, offset long")
    alone = pieces.where(full).withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("bigint")})
    return pieces.where(~full).join(placed, "row").select(alone.columns).unionByName(alone).drop("row")
