"""A star schema published as a whole."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from freight.contract import DIMENSIONS, FACT
from freight.operators.report import row_counts
from freight.plans.star_schema import materialise_star
from freight.sources.catalog import ensure_database, quoted

_PROPERTY = "freight.build"


class StarIncomplete(ValueError):
    """A build does not hold the rows it should; the published star stays as it was."""


def publish_star(
    loads: DataFrame, database: str, folder: str, mode: str = "single", buckets: int | None = None
) -> dict[str, DataFrame]:
    """Build the star beside the published one, check it, then let ``published_star`` return it.

    Each build has a database and a folder of its own under ``folder``.  The switch is one property of
    ``database``, set by one catalog statement, so readers see all tables of one build: a build that
    fails or stops leaves the old star as it was, and readers of the old one keep their files.  Builds are not
    deleted; the folder's owner sets their life time.  Of two builds at once the last to end is published.

    The check counts rows: every dimension holds as many as ``loads``, and so does the fact in ``single`` mode
    (joined, it holds at least one row for each load).
    """
    spark = loads.sparkSession
    build = f"{database}_build_{uuid.uuid4().hex[:12]}"
    star = materialise_star(loads, build, f"{folder.rstrip('/')}/{build}", mode, buckets)
    rows = {row.table_name: row.n_rows for row in row_counts({**star, "loads": loads}).collect()}
    wrong = {name: rows[name] for name in DIMENSIONS if rows[name] != rows["loads"]}
    if rows[FACT] != rows["loads"] if mode == "single" else rows[FACT] < rows["loads"]:
        wrong[FACT] = rows[FACT]
    if wrong:
        raise StarIncomplete(f"{rows['loads']} loads, but {wrong} rows in {build}")
    ensure_database(spark, f"{database}.{FACT}")
    spark.sql(f"ALTER DATABASE {quoted(database)} SET DBPROPERTIES ('{_PROPERTY}' = '{build}')")
    return star


def published_star(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The tables of the star that was published last, by name; a database without one is a ``LookupError``."""
    if spark.catalog.databaseExists(database):
        for row in spark.sql(f"DESCRIBE DATABASE EXTENDED {quoted(database)}").collect():
            found = re.search(rf"\({re.escape(_PROPERTY)},\s*([^)]*)\)", row.info_value or "")
            if row.info_name == "Properties" and found:
                return {name: spark.table(f"{quoted(found[1])}.{name}") for name in [*DIMENSIONS, FACT]}
    raise LookupError(f"no star is published in {database}")
