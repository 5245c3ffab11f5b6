"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freight.workspace import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a folder of tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """``df`` stored in the shared folder, parted ``by`` columns, and read again, so that nothing above it is computed twice."""
    path = shared_folder(df.sparkSession, label)
    schema = df.schema
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def parted(doc_id: Column | str, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the id as text leaves ``part`` when divided by ``parts``; False for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts == part, F.lit(False))


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column is called so (column names ignore case)."""
    lower = {other.lower() for other in taken}
    while name.lower() in lower:
        name += "_"
    return name


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes and rows that go to a Python worker at once.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


def bound_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches of whole texts small for this session, so that workers need little memory.

    Results never depend on it; a session that asks for smaller batches keeps them.
    """
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = spark.conf.get(key)
        size = int("".join(c for c in now if c.isdigit() or c == "-") or 0)
        if size <= 0 or size > most:
            spark.conf.set(key, str(most))
