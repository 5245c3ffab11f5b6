"""CSV delivered as one file, written by many tasks.

Every task writes its part beside the target; then the parts are joined in their order.  A file system with a
concat call of its own (HDFS) moves their blocks, no byte is copied.  On a shared folder tasks copy ranges of the
parts to their places in the new file, side by side.  Either way the target appears whole, by a rename; no
task and no process holds the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from freight.sinks.exports import export_csv

#: Bytes of a part that one task copies at most.
RANGE_BYTES = 256 << 20
_CONCAT = "fs.capability.paths.concat"


class CannotJoinFiles(NotImplementedError):
    """The file system of a delivery can neither concatenate files nor write into the middle of one."""


def export_csv_file(df: DataFrame, path: str, header: bool = True, mode: str = "error", **options) -> None:
    """Write ``df`` as the single CSV file ``path``: one header, then the rows in the order of the partitions.

    The bytes are those that a single task would write.  ``mode`` is ``error`` or ``overwrite``; the old file stays readable until
    the new one is whole.  The parts stand in a hidden folder beside the target until then.  Object stores offer
    no way to join files without sending them through one process, so there it raises ``CannotJoinFiles``,
    before anything is written: deliver a folder instead.
    """
    if mode not in ("error", "overwrite"):
        raise ValueError("mode must be 'error' or 'overwrite'")
    spark = df.sparkSession
    folder, name = path.rstrip("/").rsplit("/", 1)
    files = _Files(spark, folder)
    if not files.joins:
        raise CannotJoinFiles(f"{folder} is on a file system that cannot join files")
    if mode == "error" and files.exists(path):
        raise FileExistsError(path)
    parts = f"{folder}/.{name}-{uuid.uuid4().hex}"
    try:
        if header:
            export_csv(spark.createDataFrame([], df.schema).coalesce(1), f"{parts}/header", header=True, **options)
        export_csv(df, f"{parts}/rows", header=False, **options)
        # a name and a length for each task of the write
        found = [*(files.parts(f"{parts}/header") if header else []), *files.parts(f"{parts}/rows")]
        whole = f"{parts}/whole"
        if files.concat:
            files.concatenate([part for part, _ in found], whole)
        else:
            _copy_side_by_side(spark, found, whole)
        size = sum(length for _, length in found)
        if files.length(whole) != size:
            raise OSError(f"{whole} has {files.length(whole)} bytes instead of {size}")
        files.rename(whole, path)
    finally:
        files.delete(parts)


class _Files:
    """The Hadoop file system of a folder, as far as deliveries need it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        at = self.path(folder)
        self.system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        self.system.mkdirs(at)
        self.local = self.system.getScheme() == "file"
        # the local file system has a concat that copies in one process
        self.concat = not self.local and self.system.hasPathCapability(at, _CONCAT)
        self.joins = self.local or self.concat

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def length(self, name: str) -> int:
        return self.system.getFileStatus(self.path(name)).getLen()

    def parts(self, folder: str) -> list[tuple[str, int]]:
        """Path and length of the files that a write has left, in the order of its tasks."""
        found = [(str(s.getPath().toString()), int(s.getLen())) for s in self.system.listStatus(self.path(folder))]
        return sorted((path, length) for path, length in found if length and path.rsplit("/", 1)[1].startswith("part-"))

    def concatenate(self, parts: list[str], whole: str) -> None:
        """One file of the parts, in their order.  A file system wants them in one folder, and the first one to grow."""
        if not parts:
            self.system.create(self.path(whole)).close()
            return
        folder = whole.rsplit("/", 1)[0]
        moved = [f"{folder}/{i:08d}" for i in range(len(parts))]
        for part, to in zip(parts, moved, strict=True):
            self.rename(part, to)
        if moved[1:]:
            others = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Path, len(moved) - 1)
            for i, name in enumerate(moved[1:]):
                others[i] = self.path(name)
            self.system.concat(self.path(moved[0]), others)
        self.rename(moved[0], whole)

    def rename(self, old: str, new: str) -> None:
        if self.exists(new):
            self.system.delete(self.path(new), False)
        if not self.system.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, folder: str) -> None:
        self.system.delete(self.path(folder), True)


def _copy_side_by_side(spark: SparkSession, parts: list[tuple[str, int]], whole: str) -> None:
    """Tasks copy ranges of the parts to their places in ``whole``; a repeated task writes the same bytes again."""
    ranges, at = [], 0
    for path, length in parts:
        for first in range(0, length, RANGE_BYTES):
            ranges.append((path, first, min(RANGE_BYTES, length - first), at + first))
        at += length
    target = _local(whole)

    def copy(batches: Iterable) -> Iterator:
        import os

        import pyarrow as pa

        done = 0
        for batch in batches:
            for row in batch.to_pylist():
                source, sink = os.open(row["path"], os.O_RDONLY), os.open(target, os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    left, read, write = row["length"], row["first"], row["at"]
                    while left:
                        block = os.pread(source, min(left, 8 << 20), read)
                        if not block:
                            raise OSError(f"{row['path']} ends early")
                        written = os.pwrite(sink, block, write)
                        left, read, write, done = left - written, read + written, write + written, done + written
                    os.fsync(sink)
                finally:
                    os.close(source)
                    os.close(sink)
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["bytes"])

    if not ranges:
        open(target, "wb").close()
        return
    schema = T.StructType.fromDDL("path string, first long, length long, at long")
    rows = spark.createDataFrame([(_local(path), *rest) for path, *rest in ranges], schema)
    rows.repartition(len(ranges)).mapInArrow(copy, "bytes long").collect()


def _local(path: str) -> str:
    """The plain path of a ``file:`` path."""
    return "/" + path.removeprefix("file:").lstrip("/")
