"""Folder listings as frames."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freight.workspace import shared_folder

_TASKS_PER_CORE = 4


def listing(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """Every data file below ``folder`` (or several, or single files) that is not empty: ``path``, ``length``, ``modified``.

    Only file status is read; the binary reader skips the content column.  The default
    packing would start a task for every file of 128 MB or more, so partitions are merged
    down to a few for each core.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    files = files.coalesce(_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def listing_in_tasks(spark: SparkSession, folder: str, empty: bool = False) -> DataFrame:
    """The rows of ``listing``, found level by level in tasks: the driver learns only how many folders a level has.

    For folders whose file list is too long for the driver.  A task lists some folders of a level with
    pyarrow, which must be able to open the file system; each level is stored in the shared folder, so a
    lost task lists its own folders again.  The files of one flat folder pass one task.  Names that
    begin with a dot or an underscore (but for ``_column=value``) are left out, as are empty files (unless ``empty``), as Spark
    leaves them out; a folder that does not exist is an error.
    """
    schema = "path string, length long, modified timestamp, is_folder boolean"
    # A nested function ships to executors by value, so they need no copy of this package.
    def list_folders(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        def found(folder: str) -> Iterator[tuple]:
            if folder.startswith("file:"):
                system, name = fs.LocalFileSystem(), "/" + folder[len("file:"):].lstrip("/")
            else:
                system, name = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
            for info in system.get_file_info(fs.FileSelector(name)):
                own = info.base_name
                hidden = own.startswith(".") or own.startswith("_") and "=" not in own or own.endswith("._COPYING_")
                is_folder = info.type == fs.FileType.Directory
                if not hidden and (is_folder or info.size or empty):
                    modified = None if is_folder else info.mtime_ns // 1_000_000 * 1000
                    yield f"{folder}/{own}", None if is_folder else info.size, modified, is_folder

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()
            columns = zip(*rows) if rows else ((),) * len(types)
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types)],
                names=["path", "length", "modified", "is_folder"],
            )

        for batch in batches:
            rows: list[tuple] = []
            for folder in batch.column("path").to_pylist():
                for row in found(folder):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield batch_of(rows)
                        rows = []
            yield batch_of(rows)

    root = folder.rstrip("/")
    if "://" not in root and not root.startswith("file:"):
        root = "file:" + root
    elif root.startswith("file://"):
        root = "file:/" + root[len("file:"):].lstrip("/")
    most = _TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    store = shared_folder(spark, "listing")
    levels, folders, n = [], spark.range(1).select(F.lit(root).alias("path")), 1
    while n:
        level = f"{store}/{len(levels)}"
        folders.repartition(min(n, most), "path").mapInArrow(list_folders, schema).write.parquet(level)
        levels.append(level)
        folders = spark.read.schema(schema).parquet(level).where("is_folder").select("path")
        n = folders.count()
    return spark.read.schema(schema).parquet(*levels).where("not is_folder").select("path", "length", "modified")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored in the shared folder and read again, so that files are opened once."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system, as listings spell it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(there).toString()


def grouped_paths(files: DataFrame, whole: Iterable[str] | None = None) -> dict[str | None, list[str]]:
    """Paths for one scan of each ``kind`` of file, of files given as ``path`` and ``kind``.

    A folder whose files are all of one kind stands for them, if it is one of the ``whole`` folders or below one (None: all
    files of every folder were given).  The driver gets a line for each folder and kind, and
    the paths of files only for folders that hold several kinds, or sub-folders.
    """
    placed = files.withColumn("parent", F.regexp_replace("path", "/[^/]*$", ""))
    kinds = placed.select("parent", "kind").distinct().collect()
    parents = Counter(row.parent for row in kinds)
    mixed = {parent for parent, n in parents.items() if n > 1}
    ordered = sorted(f"{parent}/" for parent in parents)  # what lies below a folder then follows it
    mixed |= {a[:-1] for a, b in zip(ordered, ordered[1:]) if b.startswith(a)}
    if whole is not None:
        mixed |= {parent for parent in parents if not _is_below(parent, frozenset(whole))}
    paths: dict[str | None, list[str]] = {}
    for row in kinds:
        if row.parent not in mixed:
            paths.setdefault(row.kind, []).append(row.parent)
    if mixed:
        for row in placed.where(F.col("parent").isin(sorted(mixed))).select("path", "kind").collect():
            paths.setdefault(row.kind, []).append(row.path)
    return paths


def _is_below(folder: str, roots: frozenset[str]) -> bool:
    """Whether ``folder`` is one of ``roots`` or lies below one."""
    while folder not in roots and "/" in folder:
        folder = folder.rsplit("/", 1)[0]
    return folder in roots
