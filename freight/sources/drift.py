"""Reading a Parquet folder whose files do not all share one schema."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.functions.casts import cast_or_null
from freight.functions.lattice import common_type
from freight.sources.files import grouped_paths, listing, stored

log = logging.getLogger(__name__)

# What Spark says of files that do not merge, or are not Parquet; other errors are raised.
_DO_NOT_MERGE = ("CANNOT_MERGE_SCHEMAS", "COLUMN_ALREADY_EXISTS", "UNABLE_TO_INFER_SCHEMA", "is not a Parquet file")


def read_with_drift(
    spark: SparkSession, folder: str, contract: T.StructType | None = None
) -> DataFrame:
    """All readable files of ``folder`` as one frame; a column a file lacks is NULL.

    Spark's own schema merge covers added and missing columns.  It refuses files that
    disagree on a type, and files that are not Parquet.  Only then are the files
    grouped by footer schema, each group read once and cast: to ``contract`` where it
    names the column, otherwise to the narrowest type that holds all values exactly (``common_type``: numbers and
    decimals keep their digits, nested columns are merged field by field), or to string where
    there is none.  Names that differ in case only are one column, under the
    contract's or the first spelling.  The plan has one scan per distinct schema, never
    one per file.

    Files without a Parquet footer are logged and left out (``unreadable_files`` lists
    them).  ``ignoreCorruptFiles`` is not used: it would also pass over files that a
    lost node made unreadable for a moment, and over files whose types differ.
    """
    try:
        whole = spark.read.option("mergeSchema", True).parquet(folder)
    except (PySparkException, Py4JError) as refused:
        if not any(said in str(refused) for said in _DO_NOT_MERGE):
            raise
        log.warning("schemas of %s do not merge, reading by layout: %s", folder, type(refused))
        whole = None
    if whole is not None:
        return _fit(whole, _targets([whole.schema], contract))

    groups = _read_by_layout(spark, folder)
    if not groups:
        return spark.createDataFrame([], contract or T.StructType([]))
    targets = _targets([group.schema for group in groups], contract)
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [_fit(group, targets) for group in groups],
    )


def unreadable_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of ``folder`` that are not Parquet: ``path``, ``reason``."""
    return _footers(spark, folder).where(F.col("layout").isNull()).select("path", "reason")


def _read_by_layout(spark: SparkSession, folder: str) -> list[DataFrame]:
    # Schema texts stay behind as digests.
    layouts = grouped_paths(stored(_footers(spark, folder).select("path", F.md5("layout").alias("kind")), "footers"))
    if skipped := layouts.pop(None, None):
        log.warning("skipping files that are not Parquet, in or at %s", min(skipped))
    reader = spark.read.option("basePath", folder)
    return [reader.parquet(*sorted(paths)) for _, paths in sorted(layouts.items())]


def _footers(spark: SparkSession, folder: str) -> DataFrame:
    # A nested function ships to executors by value, so they need no copy of this package.
    def read_footers(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def layout(path: str) -> tuple[str | None, str | None]:
            uri = path.replace("s3a://", "s3://", 1)
            if uri.startswith("file:"):
                system, name = fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
            else:
                system, name = fs.FileSystem.from_uri(uri)
            try:
                with system.open_input_file(name) as handle:
                    schema = pq.read_schema(handle)
            except pa.ArrowInvalid as broken:  # not Parquet; I/O errors stay errors
                return None, str(broken).split("\n")[0]
            return schema.remove_metadata().to_string(show_field_metadata=False), None

        for batch in batches:
            paths = batch.column("path").to_pylist()
            layouts, reasons = zip(*map(layout, paths)) if paths else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.string()) for column in (paths, layouts, reasons)],
                names=["path", "layout", "reason"],
            )

    files = listing(spark, folder).select("path")
    return files.mapInArrow(read_footers, "path string, layout string, reason string")


def _targets(
    schemas: list[T.StructType], contract: T.StructType | None
) -> dict[str, T.DataType]:
    """The type each column is to have, in first-seen order."""
    seen: dict[str, list[T.DataType]] = {}
    spelling: dict[str, str] = {}
    declared = {field.name.lower(): field.dataType for field in contract or []}
    for field in contract or []:
        spelling[field.name.lower()] = field.name
    for schema in schemas:
        for field in schema:
            seen.setdefault(field.name.lower(), []).append(field.dataType)
            spelling.setdefault(field.name.lower(), field.name)
    return {name: declared.get(key) or common_type(seen[key]) for key, name in spelling.items()}


def _fit(df: DataFrame, targets: dict[str, T.DataType]) -> DataFrame:
    present = {field.name.lower(): field.dataType for field in df.schema}
    columns = []
    for name, wanted in targets.items():
        if name.lower() in present:
            column = cast_or_null(F.col(f"`{name}`"), present[name.lower()], wanted)
        else:
            column = F.lit(None).cast(wanted)
        columns.append(column.alias(name))
    return df.select(*columns)
