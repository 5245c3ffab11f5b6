"""Removal of repeated byte strings by bucket-pointer refinement, spread over tasks.

A byte goes if a string of ``SPAN`` bytes that covers it also starts earlier.  Buckets are refined as in
bucket-pointer refinement, from q-grams to whole strings, and only buckets that hold more than one place:

1. Each string opens at an anchor, its q-gram of least hash, so equal strings have equal anchors.  Starts with
   one anchor form a run; the bucket of a run is its anchor's q-gram.  Runs of which all bytes are equal are
   one class: all but the first are covered whole.  Within a batch this is settled before the shuffle, so a
   passage that very many documents share sends one run a batch.
2. The first runs of the classes of one bucket may still share some strings.  Their buckets are refined by
   the bytes before or behind the anchor, whichever lie in all strings of a half run.
3. For what is left, the bytes of half runs go to a task by bucket.  There, places are refined by sorting on
   the identifiers of later offsets: 25 bytes by their hash, 50 by the two 25s, 100 by the two 50s.

A bucket of more than ``HOT`` runs is never held whole: step 1 takes it in parts, class by class, and instead of
steps 2 and 3 all strings of its open runs are compared by hashes of 128 bits; their earliest places are found by
a partial aggregation.

Only hashes, places and the bytes of step 3 are shuffled, and each text once.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freight.llm.common import bound_batches, written

#: Bytes of a string whose repetition counts, and of the q-grams that open buckets.
SPAN, GRAM = 100, 25
#: Bytes that are hashed at once; a longer text is cut into pieces that overlap by a string less one.
BYTES_AT_ONCE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_PLACE = 24
#: More rows of one bucket than this are never held at once: its strings are compared by hashes, in all tasks.
HOT = 1 << 12
_SECOND_BASE = 0xC2B2AE3D27D4EB4F
#: Bytes beside the anchor that all strings of a half run hold.
_SIDE = (SPAN - GRAM) // 2 + 1
_NULL_ID = -(1 << 63)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over the whole number; one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of any string of bytes in a sequence, from running sums."""

    def __init__(self, data: np.ndarray, base: int = _BASE):
        size = max(1 << 16, 1 << int(len(data)).bit_length())
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(base, size)[: len(data)], out=self.sums[1:])
        self.back = _powers(pow(base, -1, 1 << 64), size)

    def __call__(self, first: np.ndarray | slice, past: np.ndarray | slice) -> np.ndarray:
        return mixed((self.sums[past] - self.sums[first]) * self.back[first])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima forth and back within blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    grid = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(values)] = values
    grid = grid.reshape(blocks, width)
    forth = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], forth[width - 1 : width - 1 + n])


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Hashes]:
    """Runs of string starts with one anchor: the anchor, the first start and the last one.

    ``data`` holds texts one behind the other, ``ends`` where each ends.  The anchor of a string is its q-gram
    of least hash, the leftmost of equals, so strings that are equal have equal anchors at equal places.
    """
    hashes = Hashes(data)
    if len(data) < SPAN:
        none = np.zeros(0, np.int64)
        return none, none, none, hashes
    grams = hashes(slice(0, len(data) - GRAM + 1), slice(GRAM, None))
    packed = (grams >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_least(packed, SPAN - GRAM + 1) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    # strings that end within the text in which they start
    starts = np.arange(len(anchor))
    text = np.zeros(len(data) + 1, np.int32)
    np.add.at(text, ends, 1)
    text = np.cumsum(text)
    whole = text[starts] == text[starts + SPAN - 1]
    edge = np.ones(len(anchor), bool)
    edge[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    first = np.flatnonzero(edge & whole)
    stop = np.ones(len(anchor), bool)
    stop[:-1] = (anchor[1:] != anchor[:-1]) | ~whole[1:]
    last = np.flatnonzero(stop & whole)
    return anchor[first], first, last, hashes


def _pieces(texts: list[bytes]):
    """Lists of (number of the text, place in it, bytes) of bounded size."""
    some, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - SPAN + 1), BYTES_AT_ONCE):
            piece = text[at : at + BYTES_AT_ONCE + SPAN - 1]
            if some and size + len(piece) > BYTES_AT_ONCE:
                yield some
                some, size = [], 0
            some.append((number, at, piece))
            size += len(piece)
    if some:
        yield some


def _short(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(48)).astype(np.int64)


_RUNS = "route long, bucket long, class long, id long, extra long, place long"


def _find_runs(batches):
    """Rows of runs: ``extra`` packs the text's tag and short hashes of both sides, ``place`` start, length and anchor.

    A run that has its like earlier in the batch is marked by bit 7 of the length and routed by its document.
    """
    for batch in batches:
        ids, tags = (batch.column(i).to_numpy() for i in (0, 1))
        texts = batch.column(2).to_pylist()
        for some in _pieces(texts):
            number, base = (np.array([x[i] for x in some]) for i in (0, 1))
            ends = np.cumsum([len(x[2]) for x in some])
            data = np.frombuffer(b"".join(x[2] for x in some), np.uint8)
            anchor, first, last, hashes = runs(data, ends)
            piece = np.searchsorted(ends, first, side="right")
            own, n = number[piece], last - first + 1
            start = first - (ends[piece] - np.array([len(x[2]) for x in some])[piece]) + base[piece]
            bucket = hashes(anchor, anchor + GRAM)
            alike = hashes(first, last + SPAN)
            before, behind = np.maximum(anchor - _SIDE, 0), np.minimum(anchor + GRAM + _SIDE, len(data))
            left = _short(hashes(before, anchor))
            right = _short(hashes(np.minimum(anchor + GRAM, behind), behind))
            order = np.lexsort((start, ids[own]))
            _, inverse = np.unique(mixed(bucket ^ mixed(alike))[order], return_inverse=True)
            _, leader = np.unique(inverse, return_index=True)
            leader = order[leader[inverse]]
            covered = np.zeros(len(order), bool)
            same = (ids[own[order]] == ids[own[leader]]) & (start[order] == start[leader])
            covered[order] = ~same
            place = start << 16 | (n | np.where(covered, 128, 0)) << 8 | (anchor - first)
            route = np.where(covered, mixed(ids[own].view(np.uint64)), bucket).view(np.int64)
            extra = (tags[own].astype(np.int64) << 32) | left << 16 | right
            columns = (route, route, alike.view(np.int64), ids[own], extra, place)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["route", "bucket", "class", "id", "extra", "place"])


_MARKS = "id long, tag int, kind int, first long, past long, key long"


def _marks(ids, extra, kind, first, past, key) -> pa.RecordBatch:
    tag = (extra >> 32).astype(np.int32)
    columns = (ids, tag, np.full(len(ids), kind, np.int32), first, past, key)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "tag", "kind", "first", "past", "key"])


def _several(keys: np.ndarray) -> np.ndarray:
    """Whether a value occurs more than once."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def _settle(bucket, alike, ids, extra, place):
    """Marks of whole buckets, sorted by bucket, class, id and place: covered bytes, and half runs still open."""
    start, n, ahead = place >> 16, place >> 8 & 127, place & 255
    early = (place >> 8 & 128) > 0
    yield _marks(ids[early], extra[early], 0, start[early], (start + n - 1 + SPAN)[early], ids[early])
    bucket, alike, ids, extra, start, n, ahead = (x[~early] for x in (bucket, alike, ids, extra, start, n, ahead))
    if not len(ids):
        return
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (bucket[1:] != bucket[:-1]) | (alike[1:] != alike[:-1])
    leader = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    later = (ids != ids[leader]) | (start != start[leader])
    yield _marks(ids[later], extra[later], 0, start[later], (start + n - 1 + SPAN)[later], ids[later])
    bucket, ids, extra, start, n, ahead = (x[fresh] for x in (bucket, ids, extra, start, n, ahead))
    open_ = _several(bucket)
    bucket, ids, extra, start, n, ahead = (x[open_] for x in (bucket, ids, extra, start, n, ahead))
    last, turn = start + n - 1, start + ahead - _SIDE  # from the turn back, strings hold the bytes before the anchor
    for kind, first, past, side in (
        (1, start, np.minimum(last, turn) + 1, extra >> 16 & 0xFFFF),
        (2, np.maximum(start, turn + 1), last + 1, extra & 0xFFFF),
    ):
        some = np.flatnonzero(first < past)
        key = mixed(bucket.view(np.uint64) ^ mixed((side << 2 | kind).astype(np.uint64))).view(np.int64)
        some = some[_several(key[some])] if len(some) else some
        yield _marks(ids[some], extra[some], kind, first[some], past[some], key[some])


def _by_bucket(batches, columns: int, settle):
    """Calls ``settle`` with whole buckets of rows that are sorted by the first column."""
    kept: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        arrays = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]
        cut = int(np.searchsorted(arrays[0], arrays[0][-1]))
        if cut:
            whole = [np.concatenate([*(k[i] for k in kept), arrays[i][:cut]]) for i in range(columns)]
            kept = []
            yield from settle(*whole)
        kept.append([a[cut:] for a in arrays])
    if kept:
        yield from settle(*(np.concatenate([k[i] for k in kept]) for i in range(columns)))


def _settle_hot(leader, bucket, alike, ids, extra, place):
    """As ``_settle``, for a part of one hot bucket: the first run of every class is left open, as kinds 3 and 4.

    ``leader`` is class, id and start of the first run of the class that the part before ended with, if any.
    Returns the marks, and the leader for the next part.
    """
    start, n, ahead = place >> 16, place >> 8 & 127, place & 255
    early = (place >> 8 & 128) > 0
    marks = [_marks(ids[early], extra[early], 0, start[early], (start + n - 1 + SPAN)[early], ids[early])]
    bucket, alike, ids, extra, start, n, ahead = (x[~early] for x in (bucket, alike, ids, extra, start, n, ahead))
    if not len(ids):
        return marks, leader
    fresh = np.ones(len(ids), bool)
    fresh[1:] = alike[1:] != alike[:-1]
    at = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    own, first = ids[at], start[at]
    if leader is not None and leader[0] == alike[0]:
        own[at == 0], first[at == 0] = leader[1], leader[2]
        fresh[0] = False
    later = (ids != own) | (start != first)
    marks.append(_marks(ids[later], extra[later], 0, start[later], (start + n - 1 + SPAN)[later], ids[later]))
    leader = (alike[-1], own[-1], first[-1])
    bucket, ids, extra, start, n, ahead = (x[fresh] for x in (bucket, ids, extra, start, n, ahead))
    last, turn = start + n - 1, start + ahead - _SIDE
    for kind, opens, past in ((3, start, np.minimum(last, turn) + 1), (4, np.maximum(start, turn + 1), last + 1)):
        some = opens < past
        marks.append(_marks(ids[some], extra[some], kind, opens[some], past[some], bucket[some]))
    return marks, leader


def _settle_runs(batches):
    """Calls ``_settle`` with whole buckets, and ``_settle_hot`` with parts of a bucket of more than ``HOT`` rows."""
    key, kept, size, hot, leader = None, [], 0, False, None

    def joined():
        return [np.concatenate([k[i] for k in kept]) for i in range(5)]

    # columns: bucket, class, id, extra, place
    for batch in batches:
        if not batch.num_rows:
            continue
        arrays = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        if hot:
            same = int(np.searchsorted(arrays[0], key, side="right"))
            if same:
                marks, leader = _settle_hot(leader, *(a[:same] for a in arrays))
                yield from marks
            arrays = [a[same:] for a in arrays]
            if not len(arrays[0]):
                continue
            hot, leader = False, None
        cut = int(np.searchsorted(arrays[0], arrays[0][-1]))
        if cut or kept and arrays[0][0] != key:
            kept.append([a[:cut] for a in arrays])
            yield from _settle(*joined())
            kept, size = [], 0
        key = arrays[0][-1]
        kept.append([a[cut:] for a in arrays])
        size += len(arrays[0]) - cut
        if size > HOT:
            marks, leader = _settle_hot(None, *joined())
            yield from marks
            kept, size, hot = [], 0, True
    if kept:
        yield from _settle(*joined())


def _strings(batches):
    """The strings of hot half runs by a hash of 128 bits; ``later``: another of the batch is earlier."""
    for batch in batches:
        ids, tags = (batch.column(i).to_numpy() for i in (0, 1))
        texts, halves = (batch.column(i).to_pylist() for i in (2, 3))
        found = [(i, h["first"], text[h["first"] : h["past"] - 1 + SPAN]) for i, (text, own) in enumerate(zip(texts, halves, strict=True)) for h in own]
        some, size = [], 0
        for at, half in enumerate(found):
            some.append(half)
            size += len(half[2])
            if size <= BYTES_AT_ONCE and at + 1 < len(found):
                continue
            own, first, lengths = (np.array(x, np.int64) for x in ([h[0] for h in some], [h[1] for h in some], [len(h[2]) for h in some]))
            data = np.frombuffer(b"".join(h[2] for h in some), np.uint8)
            some, size = [], 0
            counts = lengths - SPAN + 1
            row = np.repeat(np.arange(len(counts)), counts)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            places = (np.cumsum(lengths) - lengths)[row] + inner
            high, low = (Hashes(data, base)(places, places + SPAN).view(np.int64) for base in (_BASE, _SECOND_BASE))
            doc, tag, start = ids[own[row]], tags[own[row]], first[row] + inner
            order = np.lexsort((start, doc, low, high))
            high, low, doc, tag, start = (x[order] for x in (high, low, doc, tag, start))
            fresh = np.ones(len(doc), bool)
            fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            leader = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            later = (doc != doc[leader]) | (start != start[leader])
            columns = (high, low, doc, tag, start, later)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["high", "low", "id", "tag", "first", "later"])


def _hot_covers(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Covered bytes of the half runs of hot buckets: strings that are not the earliest of their hash.

    A batch sends one row for each string that it holds, and the least place is taken in part before the shuffle.
    """
    halves = marks.groupBy("id", "tag").agg(F.collect_list(F.struct("first", "past")).alias("halves"))
    strings = rows.join(halves, ["id", "tag"]).select("id", "tag", "text", "halves")
    strings = written(strings.mapInArrow(_strings, "high long, low long, id long, tag int, first long, later boolean"), "strings")
    met = strings.where("not later")
    least = met.groupBy("high", "low").agg(F.min(F.struct("id", "first")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    found = met.join(least, ["high", "low"]).where("id != least.id or first != least.first").select("id", "tag", "first")
    found = found.unionAll(strings.where("later").select("id", "tag", "first"))
    return found.select("id", "tag", "first", (F.col("first") + SPAN).alias("past"))


def _cut(batches):
    """The bytes of open half runs, by bucket."""
    for batch in batches:
        ids, tags = (batch.column(i).to_numpy() for i in (0, 1))
        keys, out_ids, out_tags, firsts, texts = [], [], [], [], []
        for i, (text, halves) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            for half in halves:
                keys.append(half["key"])
                out_ids.append(ids[i])
                out_tags.append(tags[i])
                firsts.append(half["first"])
                texts.append(text[half["first"] : half["past"] - 1 + SPAN])
        columns = (pa.array(keys, pa.int64()), pa.array(out_ids, pa.int64()), pa.array(out_tags, pa.int32()), pa.array(firsts, pa.int64()), pa.array(texts, pa.binary()))
        yield pa.RecordBatch.from_arrays(list(columns), ["key", "id", "tag", "first", "text"])


def refined(data: np.ndarray, places: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose string occurs at another place of its group too, and the identifier of the string.

    Identifiers of q-grams, in groups, are refined by those of later offsets, to twice the length each time;
    places that are alone in their bucket drop out.
    """
    length, hashes = GRAM, Hashes(data)
    near = np.unique(np.concatenate([places + i for i in range(0, SPAN, GRAM)]))
    ids = np.zeros(len(data) + 1, np.int64)
    ids[near] = np.unique(hashes(near, near + GRAM), return_inverse=True)[1]
    while length < SPAN:
        # identifiers of twice the length, at the places and where the next round will look
        need = np.unique(np.concatenate([places + i for i in range(0, SPAN, 2 * length)]))
        pair = ids[need] * (len(data) + 1) + ids[need + length]
        refreshed = np.unique(pair, return_inverse=True)[1]
        ids = np.zeros(len(data) + 1, np.int64)
        ids[need] = refreshed
        length *= 2
        alone = ~_several(groups * (len(data) + 1) + ids[places])
        places, groups = places[~alone], groups[~alone]
    return places, groups * (len(data) + 1) + ids[places]


def _settle_halves(key, ids, tags, firsts, texts):
    """Covered bytes of the half runs of whole buckets."""
    # buckets of one call are few enough bytes for one batch; a larger bucket is taken whole
    lengths = np.array([len(text) for text in texts], np.int64)
    edges = np.flatnonzero(np.diff(key, prepend=key[0] - 1 if key[0] > _NULL_ID else key[0] + 1))
    total = np.concatenate([[0], np.cumsum(lengths)])
    at = 0
    while at < len(edges):
        end = at + 1
        while end < len(edges) and total[edges[end + 1] if end + 1 < len(edges) else len(key)] - total[edges[at]] <= BYTES_AT_ONCE:
            end += 1
        rows = slice(edges[at], edges[end] if end < len(edges) else len(key))
        at = end
        data = np.frombuffer(b"".join(texts[rows]), np.uint8)
        begin = total[rows] if rows.stop is None else total[rows.start : rows.stop] - total[rows.start]
        counts = lengths[rows] - SPAN + 1
        row = np.repeat(np.arange(len(counts)), counts)
        places = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        group = np.unique(key[rows], return_inverse=True)[1]
        found, string = refined(data, places, group[row])
        row = np.searchsorted(begin, found, side="right") - 1
        own, start = ids[rows][row], firsts[rows][row] + found - begin[row]
        order = np.lexsort((start, own, string))
        own, start, string, row = own[order], start[order], string[order], row[order]
        fresh = np.ones(len(own), bool)
        fresh[1:] = string[1:] != string[:-1]
        leader = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(own) else np.zeros(0, np.int64)
        later = (own != own[leader]) | (start != start[leader])
        own, start, row = own[later], start[later], row[later]
        # starts that follow each other within a half run make one span
        order = np.lexsort((start, row))
        own, start, row = own[order], start[order], row[order]
        opens = np.ones(len(own), bool)
        opens[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
        closes = np.ones(len(own), bool)
        closes[:-1] = opens[1:]
        columns = (own[opens], tags[rows][row[opens]], start[opens], start[closes] + SPAN)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "tag", "first", "past"])


def _refine_halves(batches):
    yield from _by_bucket(batches, 5, _settle_halves)


_KEPT = "struct<kept:binary,spans:array<struct<first:bigint,past:bigint>>>"


def _without(text: pa.Array, covers: pa.Array) -> pa.Array:
    kept, spans = [], []
    for value, cover in zip(text.to_pylist(), covers, strict=True):
        merged = []
        if cover.is_valid and len(cover):
            first, past = (cover.values.field(i).to_numpy() for i in (0, 1))
            order = np.argsort(first, kind="stable")
            first, past = first[order], np.maximum.accumulate(past[order])
            opens = np.ones(len(first), bool)
            opens[1:] = first[1:] > past[:-1]
            closes = np.append(opens[1:], True)
            merged = list(zip(first[opens].tolist(), past[closes].tolist(), strict=True))
        edges = [0, *(x for span in merged for x in span), len(value)]
        kept.append(b"".join(value[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        spans.append([{"first": a, "past": b} for a, b in merged])
    kind = pa.struct([("kept", pa.binary()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())])))])
    return pa.array([{"kept": k, "spans": s} for k, s in zip(kept, spans, strict=True)], kind)


def remove_repeats(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``<id_column>, n_bytes, kept, spans`` of each document: what is left of its bytes, and the removed runs.

    A string is earlier by a smaller id (null is smallest), or by an earlier start under the same id; rows that
    share an id are one document as regards the order, and equal starts there are no repeat.  Null texts count as
    empty.  Other columns play no part.
    """
    bound_batches(documents.sparkSession)
    value = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_NULL_ID)).alias("id"), F.hash(value).alias("tag"), value.cast("binary").alias("text")
    )
    found = rows.mapInArrow(_find_runs, _RUNS).repartition("route").drop("route")
    found = found.sortWithinPartitions("bucket", "class", "id", "place")
    marks = written(found.mapInArrow(_settle_runs, _MARKS), "marks")
    halves = marks.where("kind in (1, 2)").groupBy("id", "tag").agg(F.collect_list(F.struct("first", "past", "key")).alias("halves"))
    cut = rows.join(halves, ["id", "tag"]).select("id", "tag", "text", "halves").mapInArrow(_cut, "key long, id long, tag int, first long, text binary")
    refined_ = cut.repartition("key").sortWithinPartitions("key").mapInArrow(_refine_halves, "id long, tag int, first long, past long")
    covers = marks.where("kind = 0").select("id", "tag", "first", "past").unionAll(refined_)
    hot = marks.where("kind > 2")
    if not hot.isEmpty():
        covers = covers.unionAll(_hot_covers(rows, hot))
    covers = covers.groupBy("id", "tag").agg(F.collect_list(F.struct("first", "past")).alias("covers"))
    joined = rows.join(covers, ["id", "tag"], "left")
    done = joined.select(
        F.when(F.col("id") != _NULL_ID, F.col("id")).alias(id_column), F.length("text").cast("long").alias("n_bytes"), F.arrow_udf(_without, _KEPT)("text", "covers").alias("done")
    )
    return done.select(id_column, "n_bytes", "done.kept", "done.spans")


def digests(removed: DataFrame) -> DataFrame:
    """What ``remove_repeats`` returns, with counts and a SHA-256 in place of bytes and spans."""
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
