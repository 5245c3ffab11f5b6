"""CSV whose quoted values hold line breaks, read by many tasks a file."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of CSV files: ``record``, the text, and ``first``, whether it is the first of its file.

    A line break ends a record unless the number of quote signs before it in the file is odd.  Files are read as lines,
    in chunks of ``spark.sql.files.maxPartitionBytes``.  One aggregate counts the lines of each chunk that have an odd number of
    quotes, and a running sum over the chunks of a file tells which of them begin inside quotes; that is one row a chunk, which
    goes to every task.  The task that reads a chunk then joins the lines of the records that begin and end in it, a batch at a
    time.  The lines of the others, the one open where a chunk begins and the one open where it ends, meet by record: a
    chunk through which no line closes the quotes passes its record on to the next.

    The text is read three times; of it only the lines of records that reach over the end of a chunk are shuffled, and nothing is
    sorted but these.  A task holds the record at hand, and a long file has as many tasks as chunks.  Empty lines between
    records are left out.  In a file whose first line ends in a carriage return and a line feed, these two are one break, also
    inside quotes.  Quote signs within an unquoted value are not allowed, since they count; a quote that is never closed makes
    one record of all that follows in its file.
    Files must be text or packed text (a packed file is one chunk, unless its packing can be split), in UTF-8.
    """
    value, line = F.col("value"), F.col("line")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        ((F.octet_length("value") - F.octet_length(F.replace(value, F.lit('"')))) % 2).alias("odd"),
    )
    placed = lines.join(F.broadcast(_chunks(lines)), ["file", "block"])
    opened, two_signs, origin, closes, opens, header, block = (F.col("state")[i] for i in range(7))
    text = F.when((two_signs == 1) & F.endswith("value", F.lit("\r")), F.expr("left(value, length(value) - 1)")).otherwise(value)
    first = F.coalesce(line == header, F.lit(False))

    texts = placed.select("chunk", opened.alias("opened"), "odd", first.alias("first"), text.cast("binary").alias("text"))
    whole = texts.mapInArrow(_whole_records(), "first boolean, record binary").withColumn("record", F.col("record").cast("string"))

    carried = (opened == 1) & F.coalesce(line <= closes, F.lit(True))
    broken = placed.where(carried | F.coalesce(line >= opens, F.lit(False))).select(
        F.when(carried, origin).otherwise(F.col("chunk")).alias("from_chunk"),
        F.struct(block.alias("block"), "line", text.alias("text")).alias("part"),
        first.alias("first"),
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda part: part["text"]), "\n")
    mended = broken.groupBy("from_chunk").agg(F.max("first").alias("first"), joined.alias("record"))
    return whole.unionByName(mended.select("first", "record"))


def _chunks(lines: DataFrame) -> DataFrame:
    """One row a chunk: a number for it, and its ``state``.

    The state is 1 if the chunk begins inside quotes, 1 if the file's first line ends in a carriage return, the
    chunk in which the record open at its beginning began, its first line with an odd number of quotes, the line that opens
    the quotes open at its end, the first line of the file that is not empty, and its place in the file; NULL where there is none.
    An array is not pruned by item, so that both parts of the union above read the same columns and share these rows.
    """
    value, odd = F.col("value"), F.col("odd") == 1
    counted = lines.groupBy("file", "block").agg(
        F.sum("odd").alias("turns"),
        F.min_by(F.endswith("value", F.lit("\r")).cast("long"), "line").alias("returns"),
        F.min("line").alias("chunk"),
        F.min(F.when(odd, F.col("line"))).alias("first_odd"),
        F.max(F.when(odd, F.col("line"))).alias("last_odd"),
        F.min(F.when(value != "", F.col("line"))).alias("filled"),
        F.min(F.when(~value.isin("", "\r"), F.col("line"))).alias("filled_before_return"),
    )
    blocks = Window.partitionBy("file").orderBy("block")
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    from_start = blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = counted.withColumn("open", F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2)
    passes = (F.col("open") == 1) & (F.col("turns") == 0)
    ends_open = (F.col("open") + F.col("turns")) % 2 == 1
    header = F.when(F.col("returns") == 1, F.col("filled_before_return")).otherwise(F.col("filled"))
    state = F.array(
        F.col("open"),
        F.first("returns").over(from_start),
        F.last(F.when(~passes, F.col("chunk")), ignorenulls=True).over(before),
        F.col("first_odd"),
        F.when(ends_open, F.col("last_odd")),
        F.when(F.col("block") == 0, header),
        F.col("block"),
    )
    return opened.select("file", "block", "chunk", state.alias("state"))


def _whole_records() -> Callable:
    """Joins lines, which come in their order, to the records that begin and end in one chunk."""
    # A nested function ships to executors by value, so they need no copy of this package.
    def join(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def rows(first: pa.Array, record: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([first, record], names=["first", "record"])

        # the lines of the record that is open, None if it began in another chunk
        chunk, inside, waiting, its_first = None, 0, None, False
        for batch in batches:
            chunks, odds, opened = (batch.column(name).to_numpy() for name in ("chunk", "odd", "opened"))
            edges = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if chunks[a] != chunk:
                    chunk, inside, waiting = chunks[a], int(opened[a]), None
                text, first = batch.column("text").slice(a, b - a), batch.column("first").slice(a, b - a)
                turned = (inside + np.cumsum(odds[a:b])) % 2
                ends = np.flatnonzero(turned == 0) + 1
                start = 0
                if inside:
                    start = int(ends[0]) if len(ends) else b - a
                    if waiting is not None:
                        waiting.append(text.slice(0, start))
                        if len(ends):
                            lines = pa.concat_arrays(waiting)
                            yield rows(pa.array([its_first]), pc.binary_join(pa.ListArray.from_arrays([0, len(lines)], lines), b"\n"))
                    ends = ends[1:]
                if len(ends):
                    bounds = np.concatenate([[start], ends]).astype(np.int32)
                    record = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), text), b"\n")
                    filled = pc.greater(pc.binary_length(record), 0)
                    yield rows(first.take(pa.array(bounds[:-1])).filter(filled), record.filter(filled))
                    start = int(ends[-1])
                if start < b - a:
                    waiting, its_first = [text.slice(start)], first[start].as_py()
                inside = int(turned[-1])

    return join


def parsed_records(
    records: DataFrame, schema: T.StructType, options: Mapping[str, object], header: bool = True
) -> DataFrame:
    """The values of ``csv_records`` under ``schema``, by Spark's own CSV parser; without the first record of each file if ``header``."""
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    given = {key: _as_text(value) for key, value in options.items()} | {"multiLine": "true"}
    rows = records.where(~F.col("first")) if header else records
    parsed: Column = F.from_csv("record", columns, given)
    return rows.select(parsed.alias("row")).select("row.*")


def _as_text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)
