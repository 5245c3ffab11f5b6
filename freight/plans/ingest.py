"""Raw drop to staged table."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.contract import LOAD_DATE, STAGED
from freight.operators.staging import parse_datetimes, stamp_load_date
from freight.sinks.parquet import write_partitioned
from freight.sources.catalog import declares, register_table
from freight.sources.drops import REJECTED, read_csv, rejected_rows, undeclared_columns
from freight.sources.lake import read_staged

log = logging.getLogger(__name__)


class UndeclaredColumns(ValueError):
    """A drop has columns that the contract does not name."""


def stage(raw: DataFrame, load_date: str | datetime.date | None = None) -> DataFrame:
    """Parse the declared date columns and stamp the load date; one projection."""
    return stamp_load_date(parse_datetimes(raw), load_date)


def ingest(
    spark: SparkSession,
    drop: str | list[str],
    folder: str,
    load_date: str | datetime.date | None = None,
    table: str | None = None,
    mode: str = "dynamic",
    rename: Mapping[str, str] | None = None,
    undeclared: str = "refuse",
    rejects: str | None = None,
    line_breaks: bool = False,
    mixed_headers: bool = False,
) -> DataFrame:
    """Read a CSV drop, stage it under ``folder`` and return the staged table.

    Columns are found by the names in the header, or by ``rename`` from there to the
    contract.  The drop is read once, by the write.  ``table`` also registers the folder in the
    catalog, which lists the folder only the first time.  Repeating a load date replaces that date and keeps the others.

    Columns that the contract does not name are an error, or stored as text with
    ``undeclared="keep"``, or left out with ``undeclared="drop"``.  Rows with a value that does not
    fit its type are staged with NULL there; the write counts them, a warning tells the
    number, and ``rejects`` names a folder for them, with their text, if there are any.

    ``line_breaks`` and ``mixed_headers`` are those of ``read_csv``: values with line breaks inside quotes, files with
    headers of their own.
    """
    if undeclared not in ("refuse", "keep", "drop"):
        raise ValueError("undeclared must be 'refuse', 'keep' or 'drop'")
    others = [] if undeclared == "drop" else undeclared_columns(
        spark, drop, rename=rename, line_breaks=line_breaks, mixed_headers=mixed_headers
    )
    if others and undeclared == "refuse":
        raise UndeclaredColumns(f"the contract does not name {others}")
    raw = read_csv(
        spark, drop, by_name=True, rename=rename, keep_rejected=True, keep_undeclared=bool(others),
        line_breaks=line_breaks, mixed_headers=mixed_headers,
    )
    seen = Observation()
    counted = raw.observe(seen, F.count_if(F.col(REJECTED).isNotNull()).alias("rejected"))
    written = write_partitioned(stage(counted.drop(REJECTED), load_date), folder, mode=mode)
    if rejected := seen.get["rejected"]:
        log.warning("%d rows of %s hold a value that does not fit", rejected, drop)
        if rejects:
            rejected_rows(raw).write.mode("overwrite").parquet(rejects)
    schema = T.StructType([*STAGED.fields[:-1], *(T.StructField(c, T.StringType()) for c in others), STAGED[LOAD_DATE]])
    if not table:
        return read_staged(spark, folder, schema)
    known = declares(spark, table, folder, schema)  # then only this write is new
    return register_table(spark, table, folder, schema, written=written if known else None)
