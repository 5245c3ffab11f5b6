"""The header rows of CSV files, read in tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freight.sources.files import grouped_paths, listing, qualified, stored

_READ = 64 << 10


def headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The first row of every CSV file that is not empty: ``path``, ``header``, the text as written (NULL if all lines are empty).

    Tasks read the beginning of each file, packed or not, with pyarrow, which must be able to open the file system.  A
    quoted name may hold line breaks.
    """
    # A nested function ships to executors by value, so they need no copy of this package.
    def read_headers(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        def header(path: str) -> str | None:
            uri = path.replace("s3a://", "s3://", 1)
            if uri.startswith("file:"):
                system, name = fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
            else:
                system, name = fs.FileSystem.from_uri(uri)
            with system.open_input_stream(name) as stream:
                text, start, seen, quotes = b"", 0, 0, 0
                while True:
                    more = stream.read(_READ)
                    text += more
                    while (end := text.find(b"\n", seen)) >= 0 or (not more and seen < len(text)):
                        end = len(text) if end < 0 else end
                        quotes += text.count(b'"', seen, end)
                        seen = end + 1
                        if quotes % 2 == 0:
                            row = text[start:end].decode("utf-8", "replace").removeprefix("\ufeff").removesuffix("\r")
                            if row:
                                return row
                            start = seen
                    if not more:
                        return None

        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = [header(path) for path in paths]
            columns = [pa.array(paths, pa.string()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "header"])

    return listing(spark, path).select("path").mapInArrow(read_headers, "path string, header string")


def paths_by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The files of ``path`` in groups that share a header, the first group with the smallest path.

    A folder whose files share one header stands for them; the paths of files reach the driver only for folders that
    hold several, as they do for any scan.
    """
    found = headers(spark, path).where(F.col("header").isNotNull())
    given = [qualified(spark, p) for p in ([path] if isinstance(path, str) else path)]
    groups = grouped_paths(stored(found.select("path", F.md5("header").alias("kind")), "headers"), given)
    return sorted(sorted(paths) for paths in groups.values())
