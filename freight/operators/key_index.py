"""Uniqueness of a numbered key over load dates, by stored bitmaps.

For each load date and each run of 32,768 key values one bitmap of the keys is kept, with the number of rows.  A new
date is compared with the bitmaps of the others; rows of older dates are read only where bitmaps overlap, to count
exactly.  Keys should be numbered: a bitmap takes 4 KB however few keys it holds, so for keys scattered over the
whole range of numbers ``quality.unique`` is the cheaper check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.contract import KEY, LOAD_DATE
from freight.operators.quality import unique
from freight.sinks.parquet import write_partitioned

_INDEX = f"bucket long, n_rows long, bits binary, {LOAD_DATE} string"


def key_bitmaps(loads: DataFrame, key: str = KEY) -> DataFrame:
    """``bucket, n_rows, bits, loading_date``: which keys each load date has.  Partial bitmaps are merged before the shuffle."""
    keyed = loads.where(F.col(key).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(key)).alias("bucket")
    found = keyed.groupBy(LOAD_DATE, bucket).agg(F.count("*").alias("n_rows"), F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("bits"))
    return found.select("bucket", "n_rows", "bits", LOAD_DATE)


def update_key_index(loads: DataFrame, folder: str, key: str = KEY) -> None:
    """Store the bitmaps of the load dates in ``loads``, in place of what ``folder`` has of those dates."""
    write_partitioned(key_bitmaps(loads, key), folder, by=LOAD_DATE)


def read_key_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromDDL(_INDEX)).parquet(folder)


def overlaps(index: DataFrame, date: str) -> DataFrame:
    """``loading_date, bucket`` of the bitmaps that share a key with those of ``date``, and of ``date`` itself where keys repeat or are shared.

    No row of any load is read.
    """
    new = index.where(F.col(LOAD_DATE) == date)
    old = index.where(F.col(LOAD_DATE) != date)
    pairs = old.join(new.select("bucket", F.col("bits").alias("new_bits")), "bucket")
    each = pairs.select(LOAD_DATE, "bucket", F.explode(F.array("bits", "new_bits")).alias("bits"))
    sizes = each.groupBy(LOAD_DATE, "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("together"), F.sum(F.bitmap_count("bits")).alias("apart")
    )
    shared = sizes.where("apart > together").select(LOAD_DATE, "bucket")
    own = new.where(F.col("n_rows") > F.bitmap_count("bits")).select(LOAD_DATE, "bucket")
    return shared.unionByName(own).unionByName(shared.select(F.lit(date).alias(LOAD_DATE), "bucket")).distinct()


def repeated_since(loads: DataFrame, index: DataFrame, date: str, key: str = KEY) -> DataFrame:
    """Keys of the load date ``date`` that occur more than once in ``loads``, with ``n_records`` of all dates.

    ``index`` has the bitmaps of all dates of ``loads``, the new one included.  The rows are those that ``unique`` finds in
    all of ``loads``, as far as their keys occur on the date; without an overlap no load is read at all.
    """
    places = overlaps(index, date)
    if places.isEmpty():
        return loads.sparkSession.createDataFrame([], T.StructType([T.StructField(key, loads.schema[key].dataType), T.StructField("n_records", T.LongType())]))
    bucket = F.bitmap_bucket_number(F.col(key)).alias("bucket")
    rows = loads.where(F.col(key).isNotNull()).select(LOAD_DATE, key, bucket).join(places, [LOAD_DATE, "bucket"], "left_semi")
    new = rows.where(F.col(LOAD_DATE) == date).select(key).distinct()
    return unique(rows.select(key), key).join(new, key, "left_semi")
