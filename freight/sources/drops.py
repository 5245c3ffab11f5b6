"""Raw CSV drops."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.contract import RAW
from freight.sources.files import listing
from freight.sources.headers import headers, paths_by_header
from freight.sources.records import csv_records, parsed_records

#: Column that holds the text of a row some column of which did not fit its type.
REJECTED = "_rejected"
#: Quotes inside a quoted value are doubled, as spreadsheets and pandas write them.
DIALECT = {"quote": '"', "escape": '"'}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = RAW,
    keep_rejected: bool = False,
    by_name: bool = False,
    rename: Mapping[str, str] | None = None,
    keep_undeclared: bool = False,
    line_breaks: bool = False,
    mixed_headers: bool = False,
    **options,
) -> DataFrame:
    """CSV with a header row, one file or a folder of them.

    The declared schema spares the extra pass over the data that inference needs.
    Spark binds a declared schema by position, so the header of every file is compared
    with it and a reordered file is an error instead of wrong columns.  A value that
    does not fit its type becomes NULL; ``keep_rejected`` adds the text of such rows.

    ``by_name`` takes the column order from the header of the drop instead: declared
    columns the header lacks are NULL, others in it are left out unless
    ``keep_undeclared`` adds them as text, and ``rename`` maps header names to declared
    ones.  All files of a drop must still share one header, unless ``mixed_headers`` reads the header of every
    file, in tasks, and then the files of each header in a scan of their own (by name, also those in sub-folders); undeclared columns that
    differ in case only are one.  A drop without any header is empty.

    ``schema=None`` infers the types.

    Rows must not span lines, unless ``line_breaks`` allows breaks inside quotes: files are still read by many
    tasks (see ``csv_records`` for what that costs).  ``multiLine=True`` reads such files too, one task a file.
    """
    settings = {"header": True, "mode": "PERMISSIVE", **DIALECT, **options}
    if mixed_headers:
        if schema is None:
            raise ValueError("files of several headers need a declared schema")
        return _read_each_header(spark, path, schema, keep_rejected, rename, keep_undeclared, line_breaks, options)
    reader = spark.read.options(**settings)
    if schema is None:
        return reader.options(inferSchema=True, **({"multiLine": True} if line_breaks else {})).csv(path)
    declared = schema
    if by_name:
        header = _header(spark, path, settings, line_breaks)
        names = _declared_names(header, declared, rename or {})
        types = {field.name: field.dataType for field in declared}
        schema = T.StructType(
            [T.StructField(h, types[names[h]] if h in names else T.StringType()) for h in header]
        )
    if keep_rejected:
        schema = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", REJECTED)
    if line_breaks:
        has_header = _is_true(settings["header"])
        if has_header:
            _check_headers(spark, path, settings, [f.name for f in schema if f.name != REJECTED])
        if keep_rejected:
            settings["columnNameOfCorruptRecord"] = REJECTED
        rows = parsed_records(csv_records(spark, path), schema, settings, has_header)
    else:
        rows = reader.schema(schema).option("enforceSchema", False).csv(path)
    if not by_name:
        return rows
    found = {name: column for column, name in names.items()}
    columns = [
        F.col(f"`{found[field.name]}`") if field.name in found else F.lit(None).cast(field.dataType)
        for field in declared
    ]
    others = [F.col(f"`{h}`") for h in header if h not in names] if keep_undeclared else []
    return rows.select(
        *[c.alias(f.name, metadata=f.metadata) for c, f in zip(columns, declared)],
        *others,
        *([REJECTED] if keep_rejected else []),
    )


def _is_true(setting: object) -> bool:
    return str(setting).lower() == "true"


def _header(spark: SparkSession, path: str | list[str], settings: Mapping, line_breaks: bool) -> list[str]:
    """Column names in the header of one file."""
    breaks = {"multiLine": True} if line_breaks else {}
    return spark.read.options(**{**settings, **breaks}).csv(path).columns


def _check_headers(spark: SparkSession, path: str | list[str], settings: Mapping, expected: list[str]) -> None:
    """Raise ValueError unless every file has the ``expected`` header, whatever the case."""
    rows = headers(spark, path).where(F.col("header").isNotNull())
    other = rows.groupBy("header").agg(F.min("path").alias("path"))
    wanted = F.array(*[F.lit(name.lower()) for name in expected])
    names = ", ".join(f"c{i} string" for i in range(len(expected) + 1))
    dialect = {key: str(settings[key]) for key in ("quote", "escape", "sep", "delimiter") if key in settings} | {"multiLine": "true"}
    found = F.from_csv("header", names, dialect)
    as_list = F.array_compact(F.array(*[F.lower(found[f"c{i}"]) for i in range(len(expected) + 1)]))
    wrong = other.where(as_list != wanted).agg(F.min("path").alias("path")).first().path
    if wrong is not None:
        raise ValueError(f"CSV header does not conform to the schema: {wrong}")


def _read_each_header(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    keep_rejected: bool,
    rename: Mapping[str, str] | None,
    keep_undeclared: bool,
    line_breaks: bool,
    options: Mapping,
) -> DataFrame:
    groups = paths_by_header(spark, path)
    if not groups:
        last = T.StructType().add(REJECTED, "string") if keep_rejected else T.StructType()
        return spark.createDataFrame([], T.StructType([*schema.fields, *last.fields]))
    frames = [
        read_csv(spark, paths, schema, keep_rejected, True, rename, keep_undeclared, line_breaks, **options) for paths in groups
    ]
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
    if keep_rejected:
        rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != REJECTED], REJECTED)
    return rows


def read_text_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """CSV with a header row, every column of the header as text, nothing parsed or left out."""
    reader = spark.read.options(header=True, **DIALECT, **options)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in reader.csv(path).columns])
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def undeclared_columns(
    spark: SparkSession,
    path: str | list[str],
    declared: T.StructType = RAW,
    rename: Mapping[str, str] | None = None,
    line_breaks: bool = False,
    mixed_headers: bool = False,
) -> list[str]:
    """Columns in the header of a drop, or in any header of its files, that the contract does not name."""
    groups = paths_by_header(spark, path) if mixed_headers else [path]
    found: dict[str, str] = {}
    for paths in groups:
        header = _header(spark, paths, {"header": True, **DIALECT}, line_breaks)
        names = _declared_names(header, declared, rename or {})
        for column in header:
            if column not in names:
                found.setdefault(column.lower(), column)
    return list(found.values())


def _declared_names(
    header: list[str], declared: T.StructType, rename: Mapping[str, str]
) -> dict[str, str]:
    """Header column to declared column, for those that have one; case does not matter."""
    known = {name.lower(): name for name in declared.names}
    known.update({theirs.lower(): ours for theirs, ours in rename.items()})
    return {column: known[column.lower()] for column in header if column.lower() in known}


def rejected_rows(df: DataFrame) -> DataFrame:
    """Rows of a ``keep_rejected`` read in which some value did not fit.

    The parser checks only the columns a query uses, so the condition names them all:
    a count over the result then still sees every misfit.
    """
    text = F.col(REJECTED)
    values = [F.col(name).cast("string") for name in df.columns if name != REJECTED]
    return df.where(text.isNotNull() & F.coalesce(*values, text).isNotNull())


def latest_file(spark: SparkSession, folder: str) -> str | None:
    """Path of the last file below ``folder`` in key order; None if there is none.

    Listings leave out empty files, so a drop that has nothing else is not seen: whoever
    must know of it compares the returned path with the drop that was due.

    One string reaches the driver, so that the read that follows opens this file alone.
    """
    return listing(spark, folder).agg(F.max("path").alias("path")).first().path


def latest_folder(spark: SparkSession, folder: str) -> str | None:
    """Folder of the last file: a whole drop, where a drop is written as many files."""
    path = latest_file(spark, folder)
    return path.rsplit("/", 1)[0] if path else None


def read_latest_csv(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = RAW,
    whole_drop: bool = False,
    **options,
) -> DataFrame:
    """The newest drop: its last file or, with ``whole_drop``, its last sub-folder."""
    path = latest_folder(spark, folder) if whole_drop else latest_file(spark, folder)
    if path is None:
        return spark.createDataFrame([], schema)
    return read_csv(spark, path, schema, **options)
