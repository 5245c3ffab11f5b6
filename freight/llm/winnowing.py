"""Document fingerprints by winnowing: of every window of k-gram hashes the smallest is kept, with its place.

The units of a k-gram are words with the white space before them.  A word of more than ``LONG_WORD``
code points is cut, and in scripts written without spaces each sign is a unit, so units cover every
text whole.  Of equal hashes in a window the rightmost is kept.  Guarantee: a run of ``window + gram - 1``
units that two texts share leaves a common hash in both fingerprints.

All of it is expressions of built-in functions.  Edited and next texts need the document behind each
one: documents are dealt to buckets by ranges of the id, whose limits come from one quantile aggregate,
and the first document of each bucket is also sent to the bucket before, so no sort runs in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freight.llm.common import shuffle_width

GRAM, WINDOW, LONG_WORD = 3, 8, 16
#: Scripts that put no space between words.
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
UNIT = rf"\s*(?:[{_UNSPACED}]|[^\s{_UNSPACED}]{{1,{LONG_WORD}}})|\s+"
#: Buckets of ids for each shuffle partition.
BUCKETS_EACH = 4

_LOW = 0xFFFFFFFF
_LAST = 0x7FFFFFFF


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _places(count: Column) -> Column:
    """0, 1, ... for ``count`` of at least one."""
    return F.sequence(F.lit(0), count - 1)


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """``struct<places:array<int>, hashes:array<long>>``: the kept k-grams, by place of their first unit.

    A text of fewer units than a k-gram is one k-gram; a null or empty text has none.  With fewer k-grams
    than a window there is one window.
    """

    def grams(units: Column) -> Column:
        whole = F.array(F.aggregate(units, F.lit(42).cast("long"), lambda seed, unit: F.xxhash64(seed, unit)))
        rolled = F.transform(_places(F.size(units) - (gram - 1)), lambda i: F.xxhash64(*(F.get(units, i + j) for j in range(gram))))
        return F.when(F.size(units) >= gram, rolled).when(F.size(units) > 0, whole).otherwise(F.array().cast("array<long>"))

    def lesser(step: int) -> Callable[[Column], Column]:
        return lambda a: F.transform(_places(F.size(a) - step), lambda i: F.least(F.get(a, i), F.get(a, i + step)))

    def kept(hashes: Column) -> Column:
        # the upper half of a hash decides; below it, later places count as smaller
        ranked = F.transform(hashes, lambda value, i: value.bitwiseAND(F.lit(~_LOW)) + (F.lit(_LAST) - i))
        least, reach = ranked, 1
        while reach < window:
            step = min(reach, window - reach)
            least = _let(least, lesser(step))
            reach += step
        fewest = F.filter(F.array(F.array_min(ranked)), lambda value: value.isNotNull())
        minima = F.array_distinct(F.when(F.size(hashes) > window, least).otherwise(fewest))
        places = F.transform(minima, lambda value: (F.lit(_LAST) - value.bitwiseAND(F.lit(_LOW))).cast("int"))
        return _let(places, lambda p: F.struct(p.alias("places"), F.transform(p, lambda i: F.get(hashes, i)).alias("hashes")))

    units = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0)), lambda unit: F.xxhash64(unit))
    return _let(_let(units, grams), kept)


def likeness(one: Column, other: Column) -> Column:
    """Shared hashes of two fingerprints as a part of all their hashes, from 0 to 1; 1 if both have none."""
    shared = F.size(F.array_intersect(one["hashes"], other["hashes"]))
    every = F.size(F.array_union(one["hashes"], other["hashes"]))
    return F.when(every == 0, F.lit(1.0)).otherwise(shared / every)


def digest(fingerprint: Column) -> Column:
    """A fingerprint as text: SHA-256 of its places and hashes."""
    parts = (F.concat_ws(",", fingerprint[name].cast("array<string>")) for name in ("places", "hashes"))
    return F.sha2(F.concat_ws(";", *parts), 256)


def _bucket(value: Column, limits: list[int]) -> Column:
    """How many of the sorted limits are no larger than the value, by binary search; 0 for null."""
    levels = max(1, len(limits).bit_length())
    padded = limits + [None] * ((1 << levels) - 1 - len(limits))
    text = ",".join("" if x is None else str(x) for x in padded)
    table = F.transform(F.split(F.lit(text), ","), lambda x: F.when(x != "", x.cast("long")))
    steps = F.array(*(F.lit(1 << level) for level in reversed(range(levels))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= value, at + step).otherwise(at))


def with_next(documents: DataFrame, columns: dict[str, Column], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, text`` of each document, ``columns`` made from them, and the same as ``next_...`` of the next one.

    The next document is that with the next larger id (null first; ties by a hash of the text); the last is
    followed by the first, and a single one by itself.
    """
    rows = documents.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    buckets = BUCKETS_EACH * shuffle_width(documents.sparkSession)
    shares = F.lit([i / buckets for i in range(1, buckets)])
    limits = sorted(set(rows.agg(F.percentile_approx(F.col("id").cast("long"), shares, 20 * buckets)).first()[0] or []))
    rows = rows.withColumn("bucket", _bucket(F.col("id").cast("long"), limits))
    # a row for each bucket; their number is set by the session
    found = rows.groupBy("bucket").agg(F.min(F.struct("id", "mark")).alias("first")).sort("bucket").collect()
    before = dict(zip((r["bucket"] for r in found), (r["bucket"] for r in found[-1:] + found[:-1]), strict=True))
    first = F.lit(False)
    if found:
        keys = F.create_map(*(F.lit(x) for r in found for x in (r["bucket"], r["first"]["mark"])))
        ids = [(r["bucket"], r["first"]["id"]) for r in found]
        own = F.create_map(*(F.lit(x).cast("long") if i % 2 else F.lit(x) for pair in ids for i, x in enumerate(pair)))
        first = F.element_at(keys, F.col("bucket")).eqNullSafe(F.col("mark")) & F.element_at(own, F.col("bucket")).eqNullSafe(F.col("id").cast("long"))
    lead_to = F.create_map(*(F.lit(x) for pair in before.items() for x in pair)) if before else F.create_map(F.lit(0), F.lit(0))
    stay = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    visit = F.struct(F.element_at(lead_to, F.col("bucket")).alias("bucket"), F.lit(True).alias("guest"))
    rows = rows.select("id", "text", "mark", F.inline(F.when(first, F.array(stay, visit)).otherwise(F.array(stay))))
    rows = rows.repartition("bucket").withColumns(columns)
    order = Window.partitionBy("bucket").orderBy("guest", F.col("id").asc_nulls_first(), "mark")
    names = ["text", *columns]
    rows = rows.withColumns({f"next_{name}": F.lead(name).over(order) for name in names})
    return rows.where("not guest").select("id", *names, *(f"next_{name}" for name in names))


def edited_text(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by as much of the start of the following one."""
    n = F.length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(following, F.lit(1), quarter))


def edits(documents: DataFrame) -> DataFrame:
    """Per document the digests of its fingerprint and of its edited text's, and likenesses; null texts count as empty.

    Repeated rows are documents of their own, next to each other.
    """
    filled = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(filled, {"print": fingerprint(F.col("text"))})
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = rows.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "print",
        "next_print",
        fingerprint(F.col("edited")).alias("edited_print"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digest(F.col("print")).alias("fingerprint"),
        digest(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
