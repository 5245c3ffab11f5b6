"""Latest raw drop to a CSV with a header, for whoever sends it on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freight.sinks.exports import export_csv
from freight.sinks.single_file import export_csv_file
from freight.sources.drops import latest_file, latest_folder, read_text_csv


def hand_over_latest_drop(
    spark: SparkSession, drops: str, out: str, whole_drop: bool = True, single_file: bool = False, **options
) -> DataFrame:
    """Copy the latest drop below ``drops`` to ``out`` and return what was written, as text.

    The drop goes out with the columns and values it has, whether or not the contract knows them.
    Every task writes its own part; with ``single_file`` the parts are then joined to the one file ``out``
    (see ``export_csv_file``).  ``options`` are those of the CSV writer, such as ``compression="gzip"``.  Nothing is
    gathered in one task.  Without a drop it raises ``FileNotFoundError``.
    """
    path = latest_folder(spark, drops) if whole_drop else latest_file(spark, drops)
    if path is None:
        raise FileNotFoundError(f"no drop below {drops}")
    (export_csv_file if single_file else export_csv)(read_text_csv(spark, path), out, **options)
    return read_text_csv(spark, out)
