"""Writers: partitioned Parquet, catalog tables and CSV exports."""

from freight.sinks.exports import export_csv
from freight.sinks.parquet import bucket_count, save_table, write_partitioned
from freight.sinks.single_file import CannotJoinFiles, export_csv_file

__all__ = ["CannotJoinFiles", "bucket_count", "export_csv", "export_csv_file", "save_table", "write_partitioned"]
