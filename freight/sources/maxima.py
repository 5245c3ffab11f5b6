"""Largest values of a column, from the statistics in Parquet footers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from freight.sources.files import listing

_EXACT = (T.DateType, T.TimestampNTZType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def stored_maxima(spark: SparkSession, folder: str, column: str, kind: T.DataType) -> DataFrame:
    """The largest ``column`` of each Parquet file below ``folder``, one row a file; NULL where it has no value.

    Tasks read footers only.  A row group without statistics has this one column read, in the same
    task, so the result does not depend on who wrote the files.  A file without the column gives NULL, and
    one that is not Parquet is an error.  The frame can be the ``anchor`` of ``last_period``.  ``kind`` is the column's
    type: a date, a timestamp without a zone or a whole number, whose statistics are exact.
    """
    if not isinstance(kind, _EXACT):
        raise ValueError(f"statistics of {kind.simpleString()} columns need not be exact")

    # A nested function ships to executors by value, so they need no copy of this package.
    def largest(batches: Iterable) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs

        def of_file(path: str):
            uri = path.replace("s3a://", "s3://", 1)
            if uri.startswith("file:"):
                system, name = fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
            else:
                system, name = fs.FileSystem.from_uri(uri)
            with system.open_input_file(name) as handle:
                stored = pq.ParquetFile(handle, coerce_int96_timestamp_unit="us")
                found = [f.name for f in stored.schema_arrow if f.name.lower() == column.lower()]
                if not found:
                    return None
                paths = [stored.metadata.schema.column(i).path for i in range(stored.metadata.num_columns)]
                leaf = paths.index(found[0])
                values = []
                for i in range(stored.num_row_groups):
                    group = stored.metadata.row_group(i)
                    known = group.column(leaf).statistics
                    if known is not None and known.has_min_max:
                        values.append(known.max)
                    elif not (known is not None and known.has_null_count and known.null_count == group.num_rows):
                        values.append(pc.max(stored.read_row_group(i, [found[0]]).column(0)).as_py())
                return max((value for value in values if value is not None), default=None)

        for batch in batches:
            values = [of_file(path) for path in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, arrow_type)], names=[column])

    import pyarrow as pa

    arrow_type = {
        T.DateType: pa.date32(), T.TimestampNTZType: pa.timestamp("us"), T.LongType: pa.int64(),
        T.IntegerType: pa.int32(), T.ShortType: pa.int16(), T.ByteType: pa.int8(),
    }[type(kind)]
    schema = T.StructType([T.StructField(column, kind)])
    return listing(spark, folder).select("path").mapInArrow(largest, schema)
