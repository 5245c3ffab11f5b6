"""Readers: CSV drops, Parquet folders, folder listings and catalog tables."""

from freight.sources.catalog import Written, register_table, registered_tables
from freight.sources.drift import read_with_drift, unreadable_files
from freight.sources.drops import (
    latest_file,
    latest_folder,
    read_csv,
    read_latest_csv,
    read_text_csv,
    rejected_rows,
    undeclared_columns,
)
from freight.sources.files import listing_in_tasks
from freight.sources.headers import headers
from freight.sources.lake import inventory, read_staged, read_tables, table_paths
from freight.sources.maxima import stored_maxima
from freight.sources.records import csv_records

__all__ = [
    "Written",
    "csv_records",
    "headers",
    "inventory",
    "latest_file",
    "latest_folder",
    "listing_in_tasks",
    "read_csv",
    "read_latest_csv",
    "read_staged",
    "read_tables",
    "read_text_csv",
    "read_with_drift",
    "register_table",
    "registered_tables",
    "rejected_rows",
    "stored_maxima",
    "table_paths",
    "undeclared_columns",
    "unreadable_files",
]
