"""Finding and reading the tables of a lake folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.contract import STAGED
from freight.sources.drift import read_with_drift
from freight.sources.files import listing, listing_in_tasks


def _table_of(folder: str) -> Column:
    # The listing qualifies paths ("/lake" comes back as "file:/lake/..."), so the table
    # is the segment after the first place where the folder's own path ends.
    tail = "/" + folder.split("://")[-1].strip("/") + "/"
    after = F.locate(tail, F.col("path")) + len(tail)
    return F.substring_index(F.col("path").substr(after, F.length("path")), "/", 1)


def table_paths(spark: SparkSession, folder: str, in_tasks: bool = False) -> DataFrame:
    """Files below ``folder``, an absolute path, with the table (sub-folder) each belongs to.

    ``in_tasks`` lists them in tasks, for a lake whose file list is too long for the driver (see ``listing_in_tasks``).
    """
    files = (listing_in_tasks if in_tasks else listing)(spark, folder)
    return files.select(_table_of(folder).alias("table_name"), "path", "length")


def inventory(spark: SparkSession, folder: str, in_tasks: bool = False) -> DataFrame:
    """Tables below ``folder`` with their file count and size; ``in_tasks`` is as for ``table_paths``."""
    return (
        table_paths(spark, folder, in_tasks)
        .groupBy("table_name")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """One frame per table folder; schemas may drift between the files of a table.

    The table names come to the driver: one short string per table.
    """
    names = [row.table_name for row in inventory(spark, folder).select("table_name").collect()]
    return {name: read_with_drift(spark, f"{folder.rstrip('/')}/{name}") for name in sorted(names)}


def read_staged(spark: SparkSession, folder: str, schema: T.StructType = STAGED) -> DataFrame:
    """The staged wide table under its declared schema.

    With the schema given, no footer is read for inference and ``loading_date`` stays
    a string; inferred from folder names it would become a date.
    """
    return spark.read.schema(schema).parquet(folder)
