"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

Pre-tokens are found without a regular expression.  Every code point has a class (letter, digit,
other sign, white space, apostrophe of a contraction), so a batch of texts becomes one array of
classes.  What came before matters only through a state with seven values, and a class is a function
from state to state.  Composing functions is associative, so the states at all positions come from a
blocked scan: compose within blocks, scan the blocks, apply.  The slices between boundaries go
through pair merging; a bounded cache keeps the ids of slices seen before.

Rows are independent of each other: one pass over the table, no shuffle.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterable
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freight.llm.common import bound_batches

#: A batch of texts is scanned in pieces of about so many code points; a longer text is scanned alone.
BATCH_POINTS = 1 << 20
#: Slices that the cache keeps, and the longest slice that it keeps, in code points.
CACHE_SLICES, CACHE_LENGTH = 1 << 19, 64
_BLOCK = 64

ENCODED = "struct<ids:array<int>,offsets:array<int>>"

# Classes.  QUOTE2 and QUOTE3: an apostrophe with which a contraction of so many signs would fit.
LETTER, DIGIT, OTHER, SPACE, WHITE, QUOTE2, QUOTE3, END = range(8)
#: Contractions that stand alone, fixed by the pattern of the vocabulary.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: White space, as Unicode's White_Space property has it.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# States.  FRESH: the next sign starts a pre-token; BLANK: it follows a single space, which it takes
# along; CUT2, CUT1: two or one letters of a contraction are still to come.
IN_LETTERS, IN_DIGITS, IN_OTHERS, FRESH, BLANK, CUT2, CUT1 = range(7)
_STATES = 7


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.fromiter((kinds.get(unicodedata.category(chr(point))[0], OTHER) for point in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = WHITE
    table[0x20] = SPACE
    return table


def _transitions() -> np.ndarray:
    """after[class, state]."""
    plain = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHERS, SPACE: BLANK, WHITE: FRESH, END: FRESH}
    after = np.empty((END + 1, _STATES), np.uint8)
    for kind, state in plain.items():
        after[kind] = state
    after[QUOTE2], after[QUOTE3] = CUT1, CUT2
    after[QUOTE2:END, [IN_OTHERS, BLANK]] = IN_OTHERS  # there the apostrophe joins a run of signs
    after[:, CUT2], after[:, CUT1] = CUT1, FRESH
    return after


_AFTER = _transitions()


def _compose(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Functions of state, a row each: ``second`` after ``first``."""
    return np.take_along_axis(second, first, axis=1)


def _entries(functions: np.ndarray, start: int) -> np.ndarray:
    """The state before each of a sequence of functions: solved for pairs, then filled in."""
    n = len(functions)
    entries = np.empty(n, np.uint8)
    if n < 2:
        entries[:] = start
        return entries
    first, second = functions[: n - n % 2 : 2], functions[1::2]
    pairs = _compose(first, second)
    outer = _entries(np.concatenate([pairs, functions[-1:]]) if n % 2 else pairs, start)
    entries[0::2] = outer
    entries[1::2] = first[np.arange(len(first)), outer[: len(first)]]
    return entries


def scan(kinds: np.ndarray) -> np.ndarray:
    """The state before each position of a sequence of classes."""
    blocks = -(-len(kinds) // _BLOCK)
    grid = np.full(blocks * _BLOCK, END, np.int16)
    grid[: len(kinds)] = kinds
    grid = np.ascontiguousarray(grid.reshape(blocks, _BLOCK).T) * _STATES
    after = _AFTER.ravel()
    lead = np.tile(np.arange(_STATES, dtype=np.uint8), (blocks, 1))
    for column in grid:
        lead = after[column[:, None] + lead]
    state = _entries(lead, FRESH)
    states = np.empty((_BLOCK, blocks), np.uint8)
    for i, column in enumerate(grid):
        states[i] = state
        state = after[column + state]
    return states.T.ravel()[: len(kinds)]


def boundaries(points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in texts of the given lengths that lie one behind the other.

    ``points`` are code points.  No pre-token crosses two texts: a position of class END follows each.
    """
    size = len(points) + len(lengths)
    at = np.arange(len(points)) + np.repeat(np.arange(len(lengths)), lengths)
    kinds = np.full(size + 1, END, np.uint8)
    kinds[at] = classes()[points]
    signs = np.zeros(size + 2, np.uint32)
    signs[at] = points
    quotes = np.flatnonzero(signs == ord("'"))
    for text in CONTRACTIONS:
        fits = np.logical_and.reduce([signs[quotes + i] == ord(c) for i, c in enumerate(text) if i])
        kinds[quotes[fits]] = QUOTE2 if len(text) == 2 else QUOTE3
    before = scan(kinds)
    white = (kinds == SPACE) | (kinds == WHITE)
    run = np.full(size + 1, IN_OTHERS, np.uint8)
    run[kinds == LETTER], run[kinds == DIGIT] = IN_LETTERS, IN_DIGITS
    starts = ~white & (before != run) & (before != BLANK) & (before < CUT2)
    # white space starts with its run, and its last sign stands apart if something follows
    starts[0] |= white[0]
    starts[1:] |= white[1:] & ~white[:-1]
    starts[:-1] |= white[:-1] & ~white[1:] & (kinds[1:] != END)
    return np.flatnonzero(starts[at])


#: Slices of up to so many bytes are merged side by side, in tables of these widths; longer ones by way of a heap.
WIDTHS = (8, 16, 32, 64)
_NONE = np.int32(np.iinfo(np.int32).max)


class _Pairs:
    """Ids by pair of ids: an open-addressed table in arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [
            (ranks[word[:i]] << 32 | ranks[word[i:]], rank)
            for word, rank in ranks.items()
            for i in range(1, len(word))
            if word[:i] in ranks and word[i:] in ranks
        ]
        keys, values = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        self.log2 = max(4, (8 * len(keys)).bit_length() - 1)
        self.keys, self.values = np.full(1 << self.log2, -1, np.int64), np.full(1 << self.log2, _NONE, np.int32)
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]], self.values[slots[free]] = keys[free], values[free]
            rest = self.keys[slots] != keys  # another key came first, here or before
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & ((1 << self.log2) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.log2)).astype(np.int64)

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The id that two ids merge to, or _NONE."""
        keys = first.astype(np.int64) << 32 | second
        slots = self._slot(keys)
        out, there = self.values[slots], self.keys[slots]
        open_ = np.flatnonzero((there != keys) & (there != -1))
        out[there != keys] = _NONE
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.log2) - 1)
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out


def _merge_table(ids: np.ndarray, sizes: np.ndarray, pairs: _Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Merges in every row the pair of lowest rank, leftmost first, until none has a rank."""
    rows, width = ids.shape
    ids, sizes = ids.copy(), sizes.copy()
    inside = np.arange(width - 1)[None, :] < sizes[:, None] - 1
    ranks = np.full((rows, width), _NONE, np.int32)  # of each id with the one after it
    at = np.nonzero(inside)
    ranks[at] = pairs(ids[at], ids[at[0], at[1] + 1])
    active = np.arange(rows)
    columns = np.arange(width)
    while True:
        i = ranks[active].argmin(axis=1)
        least = ranks[active, i]
        on = least != _NONE
        active, i, least = active[on], i[on], least[on]
        if not len(active):
            return ids, sizes
        from_ = np.minimum(columns[None, :] + (columns[None, :] > i[:, None]), width - 1)
        ids[active] = np.take_along_axis(ids[active], from_, axis=1)
        moved = np.take_along_axis(ranks[active], from_, axis=1)
        moved[:, -1] = _NONE
        ids[active, i] = least
        sizes[active] -= 1
        line = np.arange(len(active))
        moved[line, i] = _NONE
        after, before = np.flatnonzero(i + 1 < sizes[active]), np.flatnonzero(i > 0)
        moved[after, i[after]] = pairs(least[after], ids[active[after], i[after] + 1])
        moved[before, i[before] - 1] = pairs(ids[active[before], i[before] - 1], least[before])
        ranks[active] = moved


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same in n log n steps."""
    n = len(piece)
    left, right, ends = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = right[i]
        if gone[i] or j >= n or ends[j] != end:
            continue  # one of the two has been merged meanwhile
        gone[j], ends[i], right[i] = 1, end, right[j]
        if right[i] < n:
            left[right[i]] = i
            if (rank := ranks.get(piece[i : ends[right[i]]])) is not None:
                heapq.heappush(heap, (rank, i, ends[right[i]]))
        if left[i] >= 0 and (rank := ranks.get(piece[left[i] : end])) is not None:
            heapq.heappush(heap, (rank, left[i], end))
    return tuple(ranks[piece[i : ends[i]]] for i in range(n) if not gone[i])


class Slices:
    """Ids by slice of text.  Known slices are numbers into arrays of ids; when there are too many, all are forgotten."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, _Pairs(ranks)
        self.singles = np.array([ranks[bytes([value])] for value in range(256)], np.int32)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices, one behind the other, and how many each has."""
        if len(self.known) >= CACHE_SLICES:
            self._forget()
        numbers = np.fromiter(map(self.known.get, texts, repeat(-1)), np.int64, len(texts))
        unknown = np.flatnonzero(numbers < 0)
        flat, sizes = self.flat, self.sizes
        if len(unknown):
            new = [texts[i] for i in unknown.tolist()]
            lengths = np.fromiter(map(len, new), np.int64, len(new))
            # short ones first: only they are kept
            order = np.argsort(lengths > CACHE_LENGTH, kind="stable")
            new, kept = [new[i] for i in order.tolist()], int((lengths <= CACHE_LENGTH).sum())
            more, counts = self.merged([text.encode() for text in new])
            flat, sizes = np.concatenate([flat, more]), np.concatenate([sizes, counts])
            numbers[unknown[order]] = len(self.sizes) + np.arange(len(new))
            self.known.update(zip(new[:kept], range(len(self.sizes), len(self.sizes) + kept)))
            self.sizes = sizes[: len(self.sizes) + kept]
            self.flat = flat[: int(self.sizes.sum())]
        return flat[spread((np.cumsum(sizes) - sizes)[numbers], sizes[numbers])], sizes[numbers]

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same without the cache."""
        whole = np.fromiter(map(self.ranks.get, pieces, repeat(-1)), np.int64, len(pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = np.searchsorted(WIDTHS, lengths)
        sizes, parts = np.ones(len(pieces), np.int64), []
        done = np.flatnonzero(whole >= 0)
        parts.append((done, whole[done].astype(np.int32)))
        for i, columns in enumerate(WIDTHS):
            rows = np.flatnonzero((width == i) & (whole < 0))
            if not len(rows):
                continue
            table = np.frombuffer(b"".join(pieces[j].ljust(columns, b"\0") for j in rows.tolist()), np.uint8).reshape(-1, columns)
            ids, sizes[rows] = _merge_table(self.singles[table], lengths[rows], self.pairs)
            parts.append((rows, ids[np.arange(columns) < sizes[rows, None]]))
        for j in np.flatnonzero((width == len(WIDTHS)) & (whole < 0)).tolist():
            ids = np.array(_merge_long(pieces[j], self.ranks), np.int32)
            sizes[j] = len(ids)
            parts.append((np.array([j]), ids))
        flat, starts = np.zeros(int(sizes.sum()), np.int32), np.cumsum(sizes) - sizes
        for rows, ids in parts:
            flat[spread(starts[rows], sizes[rows])] = ids
        return flat, sizes


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))


def _distinct(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One number of a slice for each distinct slice, and for each slice the place of its like there.

    Slices are told apart by hashes from running sums; each is then compared with its like, and should two
    hashes ever agree by chance, every slice counts as distinct.
    """
    n = len(points)
    size = max(1 << 16, 1 << (n - 1).bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points + np.uint64(1)) * _powers(_BASE, size)[:n])])
    hashes = (sums[starts + lengths] - sums[starts]) * _powers(_INVERSE, size)[starts]
    _, like, place = np.unique(hashes, return_index=True, return_inverse=True)
    shift = np.repeat(starts[like[place]] - starts, lengths)
    if (lengths[like[place]] != lengths).any() or (points[np.arange(n) + shift] != points).any():
        every = np.arange(len(starts))
        return every, every
    return like, place


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one run behind the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


class Vocabulary:
    """Ranks, the bytes of every id, and the cache of merged slices."""

    @staticmethod
    def read(path: str) -> dict[bytes, int]:
        with open(path, "rb") as lines:
            return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}

    def __init__(self, path: str):
        self.ranks = self.read(path)
        words = [b""] * (max(self.ranks.values()) + 1)
        for word, rank in self.ranks.items():
            words[rank] = word
        self.lengths = np.array([len(word) for word in words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.words = np.array(words, object)
        self.slices = Slices(self.ranks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte of its text at which each token starts, and tokens per text."""
        whole = "".join(texts)
        lengths = np.array([len(text) for text in texts], np.int64)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = boundaries(points, lengths)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        widths = np.diff(starts, append=len(points))
        like, place = _distinct(points, starts, widths)
        flat, sizes = self.slices([whole[a : a + n] for a, n in zip(starts[like].tolist(), widths[like].tolist(), strict=True)])
        tokens = sizes[place]
        ids = flat[spread((np.cumsum(sizes) - sizes)[place], tokens)]
        firsts = np.searchsorted(starts, np.cumsum(lengths) - lengths)
        begin = np.concatenate([[0], np.cumsum(tokens)])[firsts]
        counts = np.diff(begin, append=len(ids))
        places = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        offsets = places[:-1] - np.repeat(places[begin], counts)
        return ids, offsets.astype(np.int32), counts

    def decode(self, ids: np.ndarray, offsets: np.ndarray, size: int) -> bytes:
        """The bytes of one text: each token's bytes are placed at its offset."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if len(ids) and ends[-1] == size and (offsets == ends - lengths).all():
            return b"".join(self.words[ids].tolist())  # tokens that follow each other without a gap
        out = np.zeros(size, np.uint8)
        out[spread(offsets, lengths)] = self.bytes[spread(self.starts[ids], lengths)]
        return out.tobytes()


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _pieces(texts: Iterable[str]) -> Iterable[list[str]]:
    piece, points = [], 0
    for text in texts:
        if piece and points + len(text) > BATCH_POINTS:
            yield piece
            piece, points = [], 0
        piece.append(text)
        points += len(text)
    if piece:
        yield piece


def _lists(values: list[np.ndarray], counts: np.ndarray) -> pa.Array:
    flat = np.concatenate([np.zeros(0, np.int32), *values])
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(text: Column, path: str) -> Column:
    """``struct<ids, offsets>`` of a text column; ``path`` names the file of ranks, on every machine.

    ``ids`` are token ids; ``offsets`` the byte of the text, from 0, at which each token starts.  A
    null text counts as empty: both arrays are empty then.
    """

    @F.arrow_udf(ENCODED)
    def encoded(column: pa.Array) -> pa.Array:
        words = vocabulary(path)
        done = [words.encode(piece) for piece in _pieces(value or "" for value in column.to_pylist())]
        counts = np.concatenate([np.zeros(0, np.int64), *(x[2] for x in done)])
        return pa.StructArray.from_arrays([_lists([x[0] for x in done], counts), _lists([x[1] for x in done], counts)], ["ids", "offsets"])

    return encoded(text)


def decode(encoded: Column, path: str) -> Column:
    """The bytes from which ``encode`` made its struct; null for a null struct."""

    @F.arrow_udf("binary")
    def decoded(column: pa.Array) -> pa.Array:
        words, out = vocabulary(path), []
        lists = [column.field(name) for name in ("ids", "offsets")]
        ids, offsets = (part.values.to_numpy() for part in lists)
        ends = lists[0].offsets.to_numpy().tolist()
        starts_too = lists[1].offsets.to_numpy().tolist()
        for row, valid in enumerate(column.is_valid().to_pylist()):
            own, at = ids[ends[row] : ends[row + 1]], offsets[starts_too[row] : starts_too[row + 1]]
            size = int(at[-1] + words.lengths[own[-1]]) if len(own) else 0
            out.append(words.decode(own, at, size) if valid else None)
        return pa.array(out, pa.binary())

    return decoded(encoded)


def encode_documents(documents: DataFrame, path: str, text: str = "text", into: str = "tokens") -> DataFrame:
    """``documents`` with a column ``into`` of ids and offsets (see ``encode``); it replaces a column of that name.

    Every row is kept as it is: null and empty texts get empty arrays, repeated rows equal ones.
    """
    bound_batches(documents.sparkSession)
    return documents.withColumn(into, encode(F.col(text), path))


def token_digests(documents: DataFrame, path: str) -> DataFrame:
    """Per document: number of tokens, SHA-256 of the ids and of the bytes decoded from them."""
    tokens = encode_documents(documents.select("doc_id", "text"), path)
    return tokens.select(
        "doc_id",
        F.size("tokens.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("tokens.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("tokens"), path), 256).alias("decoded_sha256"),
    )
