"""CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from freight.sources.drops import DIALECT


def export_csv(
    df: DataFrame, path: str, header: bool = True, mode: str = "error", **options
) -> None:
    """Write ``df`` as a folder of CSV files, each task its own part.

    ``header=True`` is the form sent to other systems, ``header=False`` the report
    export.  ``mode="error"`` refuses to replace an existing export.  Blanks at the
    ends of a value are kept; an empty text reads back as NULL.
    """
    settings = {
        "header": header,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        **DIALECT,
        **options,
    }
    df.write.mode(mode).options(**settings).csv(path)
