"""SimHash near-duplicates: 64-bit fingerprints, linked where they differ in few bits.

The comparison is exact and tiled.  Equal fingerprints are merged first.  The others are put in
classes by the number of set bits in each of their equal parts; two fingerprints that differ in r
bits have part counts that differ by r at most, summed over the parts.  A class is cut into tiles of
bounded size; only tiles of classes within the radius meet, and numpy compares them whole, by
exclusive-or and bit counts.  A pair of tiles returns a spanning forest of its links, not the links.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freight.llm.common import bound_batches, free_name, written
from freight.llm.components import components

SEED = 42
#: Fingerprints in a tile.
TILE = 1024
#: Shingles that are hashed and counted at once; bounds the memory for a long text.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint_of(text: str | None, words: int) -> int:
    """The fingerprint of one text, as a signed 64-bit number.

    A-Z are lower-cased; words are runs of anything but ASCII white space.  A bit is set if it is set
    in more than half of the hashes.  Fewer words than a shingle has make one shingle; none: 0.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: ASCII only
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    bits = np.zeros(64, np.int64)
    for first in range(0, n, SHINGLES_AT_ONCE):
        last = min(n, first + SHINGLES_AT_ONCE)
        if n == 1:
            shingles = [b" ".join(tokens)]
        else:
            shingles = map(b" ".join, zip(*(tokens[first + i : last + i] for i in range(words)), strict=True))
        hashes = np.array([xxhash.xxh64_intdigest(shingle, SEED) for shingle in shingles], np.uint64)
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, words: int) -> Column:
    """The fingerprint of a text column, as a long; null counts as empty."""

    @F.arrow_udf("long")
    def hashed(column: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(value, words) for value in column.to_pylist()], pa.int64())

    return hashed(text)


def _counts(column: Column, parts: int) -> Column:
    """Set bits of each part, as an array."""
    width = 64 // parts
    mask = -1 if width == 64 else (1 << width) - 1
    return F.array(*(F.bit_count(F.shiftrightunsigned(column, width * i).bitwiseAND(F.lit(mask).cast("long"))) for i in range(parts)))


def _offsets(parts: int, radius: int) -> list[list[int]]:
    """Differences of part counts within the radius, each of two opposite ones once, zero included."""
    steps = range(-radius, radius + 1)
    found, prefix = [], [()]
    for _ in range(parts):
        prefix = [(*p, s) for p, s in product(prefix, steps) if sum(map(abs, p)) + abs(s) <= radius]
    for p in prefix:
        if p >= (0,) * parts:
            found.append(list(p))
    return found


def _forest(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Edges that connect what the links between two tiles connect, at most one for each fingerprint."""
    n = len(left)
    nodes = left if same else np.concatenate([left, right])
    shift = 0 if same else n
    label = np.arange(len(nodes))
    found_a, found_b = [], []
    for first in range(0, n, 128):
        i, j = np.nonzero(np.bitwise_count(left[first : first + 128, None] ^ right[None, :]) <= radius)
        i = i + first
        if same:
            i, j = i[i < j], j[i < j]
        found_a.append(i)
        found_b.append(j + shift)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    while len(a):  # hook the larger label to the smaller one, then shorten the paths
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[moved], nodes[label[moved]]], axis=1)


def _compare(radius: int):
    def compare(batches):
        for batch in batches:
            same, left, right = (batch.column(i) for i in range(3))
            edges = [
                _forest(left[row].values.to_numpy().view(np.uint64), right[row].values.to_numpy().view(np.uint64), radius, same[row].as_py())
                for row in range(batch.num_rows)
            ]
            flat = np.concatenate([np.zeros((0, 2), np.uint64), *edges]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["a", "b"])

    return compare


def parts_for(distinct: int) -> int:
    """Into how many parts fingerprints are cut, so that classes stay small; the links are the same for any."""
    return 4 if distinct < 1 << 26 else 8 if distinct < 1 << 33 else 16


def links(fingerprints: DataFrame, radius: int, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """Edges ``a, b`` that connect the fingerprints (column ``fp``, distinct) within ``radius`` bits.

    Two fingerprints within the radius are in one component of these edges, and only such chains are.
    A class of any size is cut into tiles by a hash, and all its tiles meet, so none is left out.
    """
    parts = parts or parts_for(fingerprints.count())
    classed = fingerprints.select("fp", _counts(F.col("fp"), parts).alias("class"))
    sizes = classed.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("cuts"))
    tiles = (
        classed.join(sizes, "class")
        .withColumn("cut", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int"))
        .groupBy("class", "cut", "cuts")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = written(tiles, "tiles")
    width = "array<int>"
    steps = F.array(*(F.array(*map(F.lit, step)).cast(width) for step in _offsets(parts, radius)))
    classes = tiles.select("class", "cuts").distinct()
    near = classes.select("class", "cuts", F.explode(steps).alias("step")).select(
        "class", "cuts", F.zip_with("class", "step", lambda x, y: x + y).alias("other"), F.forall("step", lambda x: x == 0).alias("own")
    )
    pairs = near.join(classes.select(F.col("class").alias("other"), F.col("cuts").alias("others")), "other")
    pairs = pairs.select("class", "other", "own", "others", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut")).select(
        "class", "other", "own", "cut", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other_cut")
    )
    pairs = pairs.where(~F.col("own") | (F.col("cut") <= F.col("other_cut")))
    met = pairs.join(tiles.select("class", "cut", F.col("fps").alias("left")), ["class", "cut"]).join(
        tiles.select(F.col("class").alias("other"), F.col("cut").alias("other_cut"), F.col("fps").alias("right")), ["other", "other_cut"]
    )
    same = F.col("own") & (F.col("cut") == F.col("other_cut"))
    return met.select(same.alias("same"), "left", "right").mapInArrow(_compare(radius), "a long, b long")


def _marked(documents: DataFrame, words: int, id_column: str, text: str) -> DataFrame:
    """``id, mark, fp`` of every row, stored: ``mark`` is a hash of the text, so that (id, mark) names a document."""
    bound_batches(documents.sparkSession)
    return written(
        documents.select(
            F.col(id_column).alias("id"), F.xxhash64(text).alias("mark"), fingerprint(F.col(text), words).alias("fp")
        ),
        "fingerprints",
    )


def _groups(marked: DataFrame, radius: int) -> DataFrame:
    """``fp, component`` for each distinct fingerprint; the component is its smallest fingerprint."""
    distinct = marked.select("fp").distinct()
    reached = components(links(distinct, radius), "a", "b").withColumnRenamed("vertex", "fp")
    return distinct.join(reached, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(documents: DataFrame, words: int = 3, radius: int = 2, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """A row ``<id_column>, fingerprint, component_id`` for each row of ``documents``.

    ``fingerprint`` has 16 hex digits.  Documents whose fingerprints differ in ``radius`` bits or fewer
    are linked; ``component_id`` is the smallest id that a document reaches over links (null if no
    document there has an id).  Null and empty texts have fingerprint zero and are linked like any
    other; repeated rows give repeated rows; other columns of ``documents`` play no part.
    """
    marked = _marked(documents, words, id_column, text)
    least = marked.groupBy("fp").agg(F.min("id").alias("id"))
    groups = _groups(marked, radius).join(least, "fp")
    smallest = groups.groupBy("component").agg(F.min("id").alias("component_id"))
    labels = groups.join(smallest, "component").select("fp", "component_id")
    return marked.join(labels, "fp").select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(documents: DataFrame, words: int = 3, radius: int = 2, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``documents`` for each component of ``near_duplicates``: that with the smallest id.

    A component keeps a row without an id only if none there has one.  Of several rows with the
    smallest id the text with the smallest hash stays, and of rows with equal id and text one.
    """
    marked = _marked(documents, words, id_column, text)
    first = F.struct(F.col("id").isNull().alias("none"), "id", "mark")
    least = marked.groupBy("fp").agg(F.min(first).alias("first"))
    groups = _groups(marked, radius).join(least, "fp").groupBy("component").agg(F.min("first").alias("first"))
    kept = groups.select(F.col("first.id").alias("kept_id"), F.col("first.mark").alias("kept_mark"))
    columns = documents.columns
    mark, place = free_name(columns, "mark"), free_name(columns, "place")
    rows = documents.withColumn(mark, F.xxhash64(text))
    rows = rows.join(kept, F.col(id_column).eqNullSafe(F.col("kept_id")) & (F.col(mark) == F.col("kept_mark")), "left_semi")
    order = Window.partitionBy(id_column, mark).orderBy(F.xxhash64(*columns))
    return rows.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*columns)
