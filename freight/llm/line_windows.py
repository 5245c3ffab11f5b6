"""Removal of repeated passages of lines: overlapping windows of three consecutive lines.

Every window of a document is hashed; a window that also occurs earlier (smaller id, or the same
document further up) is a later occurrence, and all lines that later occurrences cover are removed.
Windows are judged on the input, so overlaps count.  Only hashes and positions are shuffled; the
first place of a window comes from an aggregate with partial minima, and a window that very many
documents share meets its first place in a join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freight.llm.common import free_name

WINDOW = 3


def lines_of(text: Column) -> Column:
    """The lines of a text, empty ones included; the break is ``\\n`` alone."""
    return F.split(text, "\n", -1)


def _hashes(lines: Column, salt: int) -> Column:
    return F.transform(lines, lambda line: F.xxhash64(F.lit(salt), line))


def _windows(documents: DataFrame, id_column: str, text: str, window: int) -> DataFrame:
    """``id, mark, place, key1, key2`` of every window; the two keys are 128 bits of hash."""
    marked = documents.select(
        F.col(id_column).alias("id"),
        F.xxhash64(text).alias("mark"),
        _hashes(lines_of(F.col(text)), 1).alias("one"),
        _hashes(lines_of(F.col(text)), 2).alias("two"),
    ).where(F.size("one") >= window)
    keys = F.transform(
        F.sequence(F.lit(0), F.size("one") - window),
        lambda i: F.struct(
            i.alias("place"),
            F.xxhash64(*(F.get("one", i + j) for j in range(window))).alias("key1"),
            F.xxhash64(*(F.get("two", i + j) for j in range(window))).alias("key2"),
        ),
    )
    return marked.select("id", "mark", F.inline(keys))


def covered_lines(documents: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``id, mark, covered``: the lines, from 0, that later occurrences cover, per document that has any.

    ``mark`` is the hash of the text.  Documents come in the order of id (null first), then mark.
    """
    windows = _windows(documents, id_column, text, window)
    own = F.struct("id", "mark", "place")
    first = windows.groupBy("key1", "key2").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = windows.join(first.select("key1", "key2", "first"), ["key1", "key2"]).where(own > F.col("first"))
    places = later.groupBy("id", "mark").agg(F.collect_set("place").alias("places"))
    spread = F.flatten(F.transform("places", lambda p: F.sequence(p, p + (window - 1))))
    return places.select("id", "mark", F.array_distinct(spread).alias("covered"))


def dedup_lines(documents: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``documents`` without the lines of repeated windows, with ``n_lines`` and ``n_removed``.

    A null text stays null with 0 lines; an empty one has one empty line.  Documents of fewer lines than
    a window stay as they are, and so does the first occurrence of every window.  Rows with equal id and
    text are one document and lose the same lines; rows with equal id and another text are documents of
    their own.  A text that loses all lines is empty.  Columns called like a new one are replaced.
    """
    columns = [c for c in documents.columns if c.lower() not in ("n_lines", "n_removed")]
    documents = documents.select(*columns)
    mark, covered, lines = (free_name(columns, name) for name in ("mark", "covered", "lines"))
    found = covered_lines(documents, id_column, text, window).select(
        F.col("id").alias("covered_id"), F.col("mark").alias("covered_mark"), F.col("covered").alias("covered_lines")
    )
    joined = documents.withColumn(mark, F.xxhash64(text)).join(
        found, F.col(id_column).eqNullSafe(F.col("covered_id")) & (F.col(mark) == F.col("covered_mark")), "left"
    )
    joined = joined.select(*columns, F.col("covered_lines").alias(covered), lines_of(F.col(text)).alias(lines))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    rest = F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    return joined.select(
        *(F.when(F.col(covered).isNull(), F.col(text)).otherwise(rest).alias(c) if c == text else F.col(c) for c in columns),
        F.greatest(F.size(lines), F.lit(0)).alias("n_lines"),
        F.greatest(F.size(covered), F.lit(0)).alias("n_removed"),
    )


ORACLE = """
with l as (select *, string_split(text, chr(10)) as lines from documents),
w as (select doc_id, unnest(range(1, len(lines) - 1)) as place, lines from l where len(lines) >= 3),
k as (select doc_id, place, row_number() over (
        partition by lines[place], lines[place + 1], lines[place + 2] order by doc_id, place) as nth from w),
c as (select doc_id, list_distinct(flatten(list(range(place, place + 3)))) as covered from k where nth > 1 group by doc_id)
select l.doc_id, l.lang, l.source,
       case when covered is null then text else coalesce(array_to_string(
         [lines[i] for i in range(1, len(lines) + 1) if not list_contains(covered, i)], chr(10)), '') end as text,
       coalesce(length(case when covered is null then text else array_to_string(
         [lines[i] for i in range(1, len(lines) + 1) if not list_contains(covered, i)], chr(10)) end), 0) as n_chars,
       cast(coalesce(len(lines), 0) as integer) as n_lines,
       cast(coalesce(len(covered), 0) as integer) as n_removed
from l left join c using (doc_id)
"""
