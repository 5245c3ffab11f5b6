"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in a hashed order, form blocks.  A source of weight w out of a total Q
gets a release time floor(j Q / w) and a deadline ceil((j + 1) Q / w) for its block j; each slot takes the
released block with the earliest deadline.  So after any number of slots every source has its share,
less than one block off.  When a source runs out, the weights of the others are taken of their own
total and times start anew: a phase.

A schedule repeats after Q slots, so a phase is a table of at most Q rows and arithmetic.  The tables depend
on the weights and on one count for each source only, which is all that reaches the driver.  Up to
``ROWS_AT_ONCE`` rows they are broadcast and joined with the documents.  Larger ones (hundreds of sources) are
stored piece by piece, spread in tasks to one row for each block, and joined by source and block; the
result is the same.  The place of a document within its source comes from counts of hash buckets, never
from one sorted source.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freight.workspace import shared_folder

#: Documents in a block; documents in a hash bucket, about; buckets in a group whose counts are summed at once.
BLOCK_ROWS, BUCKET_ROWS, BUCKET_GROUP = 32, 2048, 1024
#: The total of weights that flattened_weights gives, about, and the exponent by which it flattens.
RESOLUTION, FLATTEN = 1000, 0.5
#: Rows of the schedule that go out from the driver, or are broadcast, at once; repeats of a slot in one array.
ROWS_AT_ONCE, REPEATS_AT_ONCE = 100_000, 10_000
SPAN = "source string, phase int, first long, past long, weight long, total long, base long"
SLOT = "phase int, source string, nth long, slot long"


def flattened_weights(counts: dict[str, int]) -> dict[str, int]:
    """Target weights in proportion to count ** FLATTEN: large sources are held back, small ones brought forward."""
    total = sum(counts[source] ** FLATTEN for source in sorted(counts))
    return {source: max(1, int(RESOLUTION * n**FLATTEN / total + 0.5)) for source, n in counts.items()}


def earliest_deadlines(weights: list[int]) -> Iterator[int]:
    """The source of each slot of one period, by earliest deadline first."""
    total = sum(weights)
    taken = [0] * len(weights)
    waiting = [(0, i) for i in range(len(weights))]
    ready: list[tuple[int, int]] = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(taken[i] + 1) * total // weights[i]), i))
        deadline, i = heapq.heappop(ready)
        assert slot < deadline  # earliest deadline first meets all deadlines of total weight one
        taken[i] += 1
        if taken[i] < weights[i]:
            heapq.heappush(waiting, (taken[i] * total // weights[i], i))
        yield i


def period(weights: list[int]) -> list[list[int]]:
    """The slots of each source's blocks within one period."""
    slots: list[list[int]] = [[] for _ in weights]
    for slot, i in enumerate(earliest_deadlines(weights)):
        slots[i].append(slot)
    return slots


def phases(blocks: dict[str, int], weights: dict[str, int]) -> Iterator[tuple[list[dict], list[dict]]]:
    """Of each phase the blocks that its sources take, and the slots of one period.

    No slot beyond the phase's end is worked out, so all phases together have at most a slot for each block.
    """
    left = {source: n for source, n in sorted(blocks.items()) if n}
    taken = dict.fromkeys(left, 0)
    base, phase = 0, 0
    while left:
        sources = list(left)
        total = sum(weights[source] for source in sources)
        table: dict[str, list[int]] = {source: [] for source in sources}
        end = None
        for slot, i in enumerate(earliest_deadlines([weights[source] for source in sources])):
            own = table[sources[i]]
            own.append(slot)
            if len(own) == left[sources[i]]:
                end = slot + 1
                break
        if end is None:
            # nobody runs out within a period: the schedule repeats until the first one does
            ends = (divmod(n - 1, weights[source]) + (table[source],) for source, n in left.items())
            end = 1 + min(times * total + own[rest] for times, rest, own in ends)
        times, rest = divmod(end, total)
        spans, slots = [], []
        for source, own in table.items():
            n = times * weights[source] + bisect_left(own, rest) if times else len(own)
            if n:
                spans.append({"source": source, "phase": phase, "first": taken[source], "past": taken[source] + n, "weight": weights[source], "total": total, "base": base})
                slots += [{"phase": phase, "source": source, "nth": j, "slot": slot} for j, slot in enumerate(own)]
            taken[source] += n
            left[source] -= n
        yield spans, slots
        left = {source: n for source, n in left.items() if n}
        base, phase = base + end, phase + 1


def _rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from values at hand."""
    text = F.lit(json.dumps(rows))
    return spark.range(1).select(F.inline(F.from_json(text, f"array<struct<{schema}>>")))


def _schedule(spark: SparkSession, blocks: dict[str, int], weights: dict[str, int]) -> tuple[DataFrame, DataFrame, bool]:
    """The tables of all phases, and whether they are small enough to be broadcast."""
    folder, spans, slots, stored = None, [], [], 0

    def store():
        # each piece has its own folder, so a piece written anew after a failure replaces only itself
        for name, rows, schema in (("spans", spans, SPAN), ("slots", slots, SLOT)):
            _rows(spark, rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}/piece={stored}")

    for more_spans, more_slots in phases(blocks, weights):
        spans += more_spans
        slots += more_slots
        if len(slots) > ROWS_AT_ONCE:
            folder = folder or shared_folder(spark, "mix_schedule")
            store()
            spans, slots, stored = [], [], stored + 1
    if folder is None:
        return _rows(spark, spans, SPAN), _rows(spark, slots, SLOT), True
    if slots:
        store()
    return spark.read.schema(SPAN).parquet(f"{folder}/spans"), spark.read.schema(SLOT).parquet(f"{folder}/slots"), False


def _block_places(spans: DataFrame, slots: DataFrame) -> DataFrame:
    """One row for each block: ``slot_source``, ``slot_block``, ``mix_slot``; long repeats are spread in two steps."""
    each = slots.join(spans, ["phase", "source"]).where("first + nth < past")
    each = each.withColumn("times", F.expr("(past - first - nth - 1) div weight + 1"))
    each = each.withColumn("part", F.explode(F.expr(f"sequence(0L, (times - 1) div {REPEATS_AT_ONCE})")))
    each = each.withColumn("time", F.explode(F.expr(f"sequence(part * {REPEATS_AT_ONCE}, least(times, (part + 1) * {REPEATS_AT_ONCE}) - 1)")))
    return each.selectExpr("source as slot_source", "first + nth + time * weight as slot_block", "base + time * total + slot as mix_slot")


def source_key(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def _order_key(id_column: str, text: str) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit(""))))


def _running(counts: DataFrame) -> DataFrame:
    """Rows of a source before each bucket: within groups of buckets, then over the groups."""
    group = F.floor(F.col("bucket") / BUCKET_GROUP).alias("group")
    counts = counts.select("key", "bucket", "n", group)
    inner = Window.partitionBy("key", "group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("key").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("key", "group").agg(F.sum("n").alias("n"))
    groups = groups.select("key", "group", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("outer"))
    inside = counts.select("key", "group", "bucket", F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("inner"))
    return inside.join(groups, ["key", "group"]).select("key", "bucket", (F.col("outer") + F.col("inner")).alias("ahead"))


def mix(
    documents: DataFrame,
    weights: dict[str, int] | None = None,
    block_rows: int = BLOCK_ROWS,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``documents`` with ``mix_slot`` and ``mix_row``: the place of its block, and its place in the block.

    Ordered by these two, the documents are mixed to the weights (whole numbers by source; without any,
    ``flattened_weights``).  Every row is kept.  Rows without a source are the source ''; rows that agree
    in all columns are interchangeable, all other ties are broken by hashes.  The last block of a source
    may be short.  A source without a weight is an error.  An empty table gives no rows.  Columns
    called like a new one are replaced.
    """
    spark = documents.sparkSession
    columns = [c for c in documents.columns if c.lower() not in ("mix_slot", "mix_row")]
    total = {row["key"]: row["n"] for row in documents.groupBy(source_key(F.col(source)).alias("key")).agg(F.count(F.lit(1)).alias("n")).collect()}
    weights = weights or flattened_weights(total)
    if missing := sorted(set(total) - {s for s, w in weights.items() if w > 0}):
        raise ValueError(f"sources without a weight: {missing[:10]}")
    span, slot, small = _schedule(spark, {s: -(-n // block_rows) for s, n in total.items()}, weights)

    buckets = max(1, -(-sum(total.values()) // BUCKET_ROWS))
    rows = documents.select(F.struct(*(F.col(c) for c in columns)).alias("row"), source_key(F.col(source)).alias("key"), _order_key(id_column, text).alias("hash"))
    bucket = F.shiftright(F.conv(F.substring("hash", 1, 8), 16, 10).cast("long") * F.lit(buckets), 32).alias("bucket")
    rows = rows.select("row", "key", "hash", bucket)
    ahead = _running(rows.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("n")))
    within = Window.partitionBy("key", "bucket").orderBy("hash", F.xxhash64("row"))
    ranked = rows.withColumn("nth", F.row_number().over(within) - 1).join(ahead, ["key", "bucket"])
    ranked = ranked.withColumn("nth", F.col("nth") + F.col("ahead"))
    ranked = ranked.withColumn("block", F.floor(F.col("nth") / block_rows)).withColumn("mix_row", (F.col("nth") % block_rows).cast("int"))
    if not small:
        # a block has few documents, so no key of this join is hot
        places = _block_places(span, slot)
        placed = ranked.join(places, (F.col("key") == F.col("slot_source")) & (F.col("block") == F.col("slot_block")))
        return placed.select("row.*", "mix_slot", "mix_row")
    # both have at most ROWS_AT_ONCE rows
    span = span.withColumnRenamed("source", "span_source")
    slot = slot.select(F.col("phase").alias("slot_phase"), F.col("source").alias("slot_source"), F.col("nth").alias("slot_nth"), "slot")
    placed = ranked.join(
        F.broadcast(span), (F.col("key") == F.col("span_source")) & (F.col("block") >= F.col("first")) & (F.col("block") < F.col("past"))
    ).withColumn("step", F.col("block") - F.col("first"))
    placed = placed.join(
        F.broadcast(slot),
        (F.col("phase") == F.col("slot_phase")) & (F.col("key") == F.col("slot_source")) & (F.col("step") % F.col("weight") == F.col("slot_nth")),
    )
    place = F.col("base") + F.floor(F.col("step") / F.col("weight")) * F.col("total") + F.col("slot")
    return placed.select("row.*", place.cast("long").alias("mix_slot"), "mix_row")


ORACLE = f"""
with recursive ranked as (
  select *, coalesce(source, '') as key, row_number() over (partition by coalesce(source, '') order by
    md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, ''))) - 1 as nth from documents),
counted as (select key, count(*) as n, cast(ceil(count(*) / {BLOCK_ROWS}.0) as bigint) as blocks from ranked group by key),
weighed as (select *, greatest(1, cast(floor({RESOLUTION} * pow(n, {FLATTEN}) / (sum(pow(n, {FLATTEN})) over ()) + 0.5) as bigint)) as w from counted),
start as (select list(key order by key) as keys, list(blocks order by key) as blocks, list(w order by key) as w from weighed),
step as (
  select cast(-1 as bigint) as slot, cast(0 as bigint) as t, cast(0 as bigint) as pick, blocks as remaining,
    [cast(0 as bigint) for b in blocks] as done, cast(list_sum(blocks) as bigint) as size from start
  union all
  select slot + 1, case when emptied then 0 else t + 1 end, pick, remaining,
    case when emptied then [cast(0 as bigint) for d in done] else done end, size
  from (
    select slot, t, size, p as pick, remaining[p] = 1 as emptied,
      [case when i = p then remaining[i] - 1 else remaining[i] end for i in range(1, len(remaining) + 1)] as remaining,
      [case when i = p then done[i] + 1 else done[i] end for i in range(1, len(done) + 1)] as done
    from (
      select *, list_min([((done[i] + 1) * total + w[i] - 1) // w[i] * 100000 + i for i in range(1, len(w) + 1)
        if remaining[i] > 0 and done[i] * total // w[i] <= t]) % 100000 as p
      from (select step.*, w, cast(list_sum([w[i] for i in range(1, len(w) + 1) if remaining[i] > 0]) as bigint) as total
            from step, start where slot + 1 < size))
  )
),
placed as (select slot, keys[pick] as key, row_number() over (partition by pick order by slot) - 1 as block from step, start where slot >= 0)
select doc_id, text, lang, source, n_chars, cast(slot as bigint) as mix_slot, cast(nth % {BLOCK_ROWS} as integer) as mix_row
from ranked join placed on ranked.key = placed.key and ranked.nth // {BLOCK_ROWS} = placed.block
"""
