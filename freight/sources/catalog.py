"""Making a partitioned Parquet folder queryable by name."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from freight.contract import LOAD_DATE, STAGED


# The folder name of a partition without a value, and how many partitions one statement names.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_PER_STATEMENT = 200


@dataclass(frozen=True)
class Written:
    """The partitions that one write made.

    ``values`` has a row for each, with the values of ``columns`` as text (None: no value); with ``replaced_all``
    the folder holds no others any more.
    """

    columns: tuple[str, ...]
    values: frozenset[tuple[str | None, ...]]
    replaced_all: bool


def quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, table: str, folder: str | None = None) -> None:
    """Create the database of a qualified table name, at ``folder`` if given."""
    if "." in table:
        location = f" LOCATION {_literal(folder)}" if folder else ""
        database = quoted(table.rsplit(".", 1)[0])
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{location}")


def register_table(
    spark: SparkSession,
    name: str,
    folder: str,
    schema: T.StructType = STAGED,
    partitioned_by: str | None = LOAD_DATE,
    written: Written | Iterable[Written] | None = None,
) -> DataFrame:
    """Declare ``folder`` as the external table ``name`` with the partitions it has now.

    ``written`` names the writes since the last call, in their order, as ``write_partitioned`` returns them: only
    their partitions are added, and the others go if a write replaced all, so the folder is not listed.  The first
    call for a folder needs all of its writes.  Without ``written``, or if the schema alone changed, the whole
    folder is compared with the catalog.

    Column comments of ``schema`` go into the catalog.  Running it again follows the folder: new load
    dates are added and removed ones go; another folder or schema replaces the definition,
    never the data.  A table that owns its data is not replaced: that raises ``ValueError``.
    """
    ensure_database(spark, name)
    columns = ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}"
        + (f" COMMENT {_literal(f.metadata['comment'])}" if "comment" in f.metadata else "")
        for f in schema
    )
    by = f"PARTITIONED BY ({quoted(partitioned_by)})" if partitioned_by else ""
    writes = None if written is None else [written] if isinstance(written, Written) else list(written)
    if spark.catalog.tableExists(name):
        same_folder, same_columns = _declares(spark, name, folder, schema)
        if not (same_folder and same_columns):
            spark.sql(f"DROP TABLE {quoted(name)}")
        if same_folder and not same_columns:
            writes = None  # partitions known to the old definition only
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}) USING parquet {by} "
        f"LOCATION {_literal(folder)}"
    )
    if partitioned_by and writes is None:
        spark.sql(f"MSCK REPAIR TABLE {quoted(name)} SYNC PARTITIONS")
    elif partitioned_by:
        _follow(spark, name, partitioned_by, writes)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _follow(spark: SparkSession, name: str, column: str, writes: list[Written]) -> None:
    """Add the partitions that ``writes`` made and drop those that they replaced."""
    if other := {w.columns for w in writes if w.columns != (column,)}:
        raise ValueError(f"{name} is partitioned by {column}, a write by {sorted(other)}")
    made: set[tuple[str | None, ...]] = set()
    for write in writes:
        made = set(write.values) if write.replaced_all else made | write.values
    if any(write.replaced_all for write in writes):
        known = set()
        for row in spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect():
            value = unquote(row.partition.partition("=")[2])
            known.add((None if value == _NO_VALUE else value,))
        _alter(spark, name, "DROP IF EXISTS", column, known - made, ", ")
    _alter(spark, name, "ADD IF NOT EXISTS", column, made, " ")


def _alter(spark: SparkSession, name: str, verb: str, column: str, values: set, between: str) -> None:
    specs = sorted(
        f"PARTITION ({quoted(column)} = {'NULL' if value is None else _literal(value)})" for (value,) in values
    )
    for at in range(0, len(specs), _PER_STATEMENT):
        spark.sql(f"ALTER TABLE {quoted(name)} {verb} {between.join(specs[at:at + _PER_STATEMENT])}")


def _declares(spark: SparkSession, name: str, folder: str, schema: T.StructType) -> tuple[bool, bool]:
    """Whether the external table ``name`` has this folder, and whether it has these columns."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()}
    if described.get("Type") != "EXTERNAL":
        raise ValueError(f"{name} is a table with data of its own")

    def bare(path: str) -> str:
        scheme, _, rest = path.rpartition(":/")
        return (scheme if scheme not in ("", "file") else "") + "/" + rest.strip("/")

    def shape(fields) -> list[tuple[str, str, str | None]]:
        return sorted((f.name, f.dataType.simpleString(), f.metadata.get("comment")) for f in fields)

    return bare(described["Location"]) == bare(folder), shape(spark.table(name).schema) == shape(schema)


def declares(spark: SparkSession, name: str, folder: str, schema: T.StructType) -> bool:
    """Whether ``name`` is already the external table of ``folder`` with the columns of ``schema``."""
    return spark.catalog.tableExists(name) and all(_declares(spark, name, folder, schema))


def registered_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables in ``database``; the session's temporary views, which the catalog lists too, are none."""
    return sorted(table.name for table in spark.catalog.listTables(database) if not table.isTemporary)
