"""Parquet writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from freight.contract import KEY, LOAD_DATE
from freight.sources.catalog import Written, ensure_database
from freight.sources.files import listing

# Of the wide table as it is stored, packed: the sorts of a six-table join over one bucket take about thirty times as much memory.
_BUCKET_BYTES = 16 << 20


def write_partitioned(
    df: DataFrame,
    path: str,
    by: str | list[str] = LOAD_DATE,
    mode: str = "dynamic",
    rebalance: bool = False,
) -> Written:
    """Overwrite ``path`` as Parquet in one sub-folder per value of ``by``.

    ``dynamic`` replaces only the partitions present in ``df``; ``static`` replaces
    everything under ``path``.  Each task writes its own files, without a shuffle,
    which suits the usual single load date.  For many values set ``rebalance``: rows
    are brought together by value and adaptive execution splits a value that is too
    big for one task.

    The partitions it made are returned, for ``register_table``.  They are seen by the write itself: tasks
    gather the distinct values of ``by`` they write, so the driver holds as many as there are partitions.
    """
    if mode not in ("dynamic", "static"):
        raise ValueError("mode must be 'dynamic' or 'static'")
    keys = [by] if isinstance(by, str) else list(by)
    seen = Observation()
    values = F.collect_set(F.struct(*[F.nullif(F.col(f"`{k}`").cast("string"), F.lit("")).alias(k) for k in keys]))
    observed = df.observe(seen, values.alias("partitions"))
    rows = observed.hint("rebalance", *[F.col(f"`{k}`") for k in keys]) if rebalance else observed
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*keys).parquet(path)
    return Written(tuple(keys), frozenset(tuple(row) for row in seen.get["partitions"]), mode == "static")


def save_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    buckets: int | None = None,
    key: str | list[str] = KEY,
    sort_within: list[str] | None = None,
) -> DataFrame:
    """Full refresh of the catalog table ``name``, at ``path`` if given.

    With ``buckets``, rows are placed by ``key`` so that tables of equal bucket count
    join on it without a shuffle.  Several columns may make up the key, such as a key and its salt, which spreads a hot
    key over many buckets (see ``skew``); the first one counts for rows without a key.  The repartition uses the same hash as the buckets,
    so each task fills one bucket file; rows without a key stay in their own tasks rather
    than meet in one.  ``sort_within`` orders the rows of each file, which lets a later
    filter on those columns skip row groups.
    """
    spark = df.sparkSession
    ensure_database(spark, name, path.rsplit("/", 1)[0] if path else None)
    if buckets:
        keys = [key] if isinstance(key, str) else list(key)
        keyed = df.where(F.col(keys[0]).isNotNull()).repartition(buckets, *keys)
        rows = keyed.unionAll(df.where(F.col(keys[0]).isNull()))
        writer = rows.write.bucketBy(buckets, *keys)
        if sort_within:
            writer = writer.sortBy(*sort_within)
    else:
        writer = (df.sortWithinPartitions(*sort_within) if sort_within else df).write
    writer = writer.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def bucket_count(spark: SparkSession, folder: str, bytes_per_bucket: int = _BUCKET_BYTES) -> int:
    """Buckets that hold about ``bytes_per_bucket`` of the wide table stored in ``folder``.

    A join of the star takes one task a bucket, so this bounds the memory of that task whatever the size of the table.
    Raises ValueError beyond the session's limit of buckets (``spark.sql.sources.bucketing.maxBuckets``).
    """
    stored = listing(spark, folder).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first().n
    buckets = max(1, -(-stored // bytes_per_bucket))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    if buckets > most:
        raise ValueError(f"{buckets} buckets are needed; spark.sql.sources.bucketing.maxBuckets allows {most}")
    return buckets
