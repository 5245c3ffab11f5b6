"""Ingest of the drops that no earlier run has taken, by a stored record."""

from __future__ import annotations

import datetime
import logging
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freight.contract import LOAD_DATE
from freight.plans.ingest import ingest
from freight.sources.files import listing_in_tasks, stored

log = logging.getLogger(__name__)

_CLAIMS = f"path string, length long, modified timestamp, {LOAD_DATE} string, run long"
_DONE = f"{LOAD_DATE} string, run long"


class DropGone(FileNotFoundError):
    """A load date must be written again, but a file that belongs to it is no longer there."""


def ingest_new_drops(
    spark: SparkSession,
    drops: str,
    folder: str,
    record: str,
    load_date: str | datetime.date | None = None,
    rejects: str | None = None,
    **options,
) -> DataFrame:
    """Stage every CSV file below ``drops`` that ``record`` does not know, and return what was found.

    ``record`` is a folder of two small tables.  A run first claims the files that are new for its load date (today, unless given),
    then writes the dates that have claimed files, each from all its files, then notes the dates as done.  So a
    run that stops half-way loses nothing and makes no row twice: the next one writes the claimed
    dates again, under the dates they were claimed for.  A second run on one load date writes that date again with its
    older files; if one of them has left, it raises ``DropGone`` and leaves the stored date as it is.

    A file whose size or time changed after it was taken is taken again for its first load date, in place of what it held.
    Files are compared with the record by a join; the driver learns the paths of the files it reads, as any
    scan does.  Two runs on one record at the same time are not kept apart.

    Returned is a row for each file: ``path``, ``length``, ``modified``, ``status`` and the load date.  The status is
    ``taken`` (by this run, for the first time), ``changed`` (taken again), ``known`` or ``empty``.  Empty files are never
    claimed, and a warning tells if the last file in key order is one.  ``options`` are those of ``ingest`` (files may have headers of
    their own unless ``mixed_headers=False``); ``rejects`` gets a sub-folder for each date.
    """
    if "mode" in options:
        raise ValueError("a record needs the load dates that other runs wrote, so mode cannot be chosen")
    run = time.time_ns()
    date = str(load_date) if load_date else spark.sql("SELECT date_format(current_date(), 'yyyy-MM-dd')").first()[0]
    found = _found(spark, drops, record, date)

    fresh = found.where(F.col("status").isin("taken", "changed"))
    if not fresh.isEmpty():
        fresh.select("path", "length", "modified", LOAD_DATE, F.lit(run).alias("run")).write.mode("append").parquet(f"{record}/claims")
    for day, runs in _open_dates(spark, record).items():
        options.setdefault("mixed_headers", True)
        ingest(
            spark, _files_of(spark, found, record, day), folder, day,
            rejects=f"{rejects.rstrip('/')}/{day}" if rejects else None, **options,
        )
        done = spark.createDataFrame([(day, claimed) for claimed in runs], _DONE)
        done.coalesce(1).write.mode("append").parquet(f"{record}/done")

    last = found.agg(F.max_by("status", "path").alias("status"), F.max("path").alias("path")).first()
    if last.status == "empty":
        log.warning("the newest file is empty: %s", last.path)
    return found


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _claimed(spark: SparkSession, record: str) -> DataFrame:
    """The last claim of each file."""
    claims = _read(spark, f"{record}/claims", _CLAIMS)
    newest = F.max_by(F.struct("length", "modified", LOAD_DATE), "run").alias("claim")
    return claims.groupBy("path").agg(newest).select("path", "claim.*")


def _found(spark: SparkSession, drops: str, record: str, date: str) -> DataFrame:
    """The files that are there, each with its status and the load date it belongs to."""
    listed = listing_in_tasks(spark, drops, empty=True)
    known = _claimed(spark, record).select(
        "path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"), LOAD_DATE
    )
    same = (F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_modified"))
    status = (
        F.when(F.coalesce(F.col("length"), F.lit(0)) == 0, "empty")
        .when(F.col("old_length").isNull(), "taken")
        .when(same, "known")
        .otherwise("changed")
    )
    day = F.when(F.col("status") != "empty", F.coalesce(LOAD_DATE, F.lit(date)))
    files = listed.join(known, "path", "left").withColumn("status", status).withColumn(LOAD_DATE, day)
    return stored(files.select("path", "length", "modified", "status", LOAD_DATE), "arrivals")


def _open_dates(spark: SparkSession, record: str) -> dict[str, list[int]]:
    """Load dates that were claimed but not noted as done, with the runs that claimed them, oldest date first."""
    claims = _read(spark, f"{record}/claims", _CLAIMS).select(LOAD_DATE, "run").distinct()
    rest = claims.join(_read(spark, f"{record}/done", _DONE), [LOAD_DATE, "run"], "left_anti")
    dates: dict[str, list[int]] = {}
    for row in rest.orderBy(LOAD_DATE, "run").collect():
        dates.setdefault(row[LOAD_DATE], []).append(row.run)
    return dates


def _files_of(spark: SparkSession, found: DataFrame, record: str, day: str) -> list[str]:
    """All files that belong to one load date; an error if one has left or is empty by now."""
    there = found.where(F.col("status") != "empty").select("path", F.lit(True).alias("there"))
    wanted = _claimed(spark, record).where(F.col(LOAD_DATE) == day).join(there, "path", "left")
    gone = wanted.where(F.col("there").isNull()).agg(F.min("path").alias("path")).first().path
    if gone is not None:
        raise DropGone(f"{day} cannot be written again without {gone}")
    return [row.path for row in wanted.select("path").orderBy("path").collect()]
