"""The test tables as freight loads: one load per order.

Prepared once per session and input state, in the order the jobs would run:
``loads_from_tables`` becomes a raw CSV drop, the drop is ingested into the staged table,
and the staged table becomes the star schema.  The queries read those.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freight.contract import DIMENSIONS, FACT, RAW
from freight.operators import parse_datetimes
from freight.plans import ingest, materialise_star
from freight.sinks import bucket_count, export_csv
from freight.sources import read_csv, read_staged
from freight.sources.files import listing
from freight.workspace import shared_folder

LOAD_DATE = "2024-05-01"
_TABLES = ["orders", "lineitem", "customer", "supplier", "part", "nation", "region"]
_written: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(column: str) -> Column:
    """A timestamp as a raw drop writes it (``M/d/yyyy H:mm``), whatever the session zone."""
    parts = [
        F.month(column), F.lit("/"), F.day(column), F.lit("/"), F.year(column), F.lit(" "),
        F.hour(column), F.lit(":"), F.lpad(F.minute(column).cast("string"), 2, "0"),
    ]
    return F.concat(*parts)


def loads_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw load per order; orders without line items have no lane, dates or carrier."""

    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    def place(prefix: str) -> DataFrame:
        """Nation and region, as the city and state of one end of a lane."""
        return read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias(f"{prefix}_nation"),
            F.concat("n_name", F.lit(","), "r_name").alias(prefix),
        )

    trip = read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_suppkey").alias("s_suppkey"),
        F.min("l_partkey").alias("p_partkey"),
        F.min("l_shipdate").alias("pickup"),
        F.max("l_shipdate").alias("delivery"),
        F.max("l_extendedprice").alias("source_price"),
        F.sum("l_quantity").alias("mileage"),
        F.count("*").alias("n_lines"),
    )
    shipper = (
        read("customer")
        .join(place("destination"), F.col("c_nationkey") == F.col("destination_nation"))
        .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "destination")
    )
    carrier = (
        read("supplier")
        .join(place("origin"), F.col("s_nationkey") == F.col("origin_nation"), "left")
        .select("s_suppkey", "s_name", "s_acctbal", "origin")
    )
    equipment = read("part").select("p_partkey", "p_type")
    joined = (
        read("orders")
        .join(trip, "o_orderkey", "left")
        .join(shipper, "o_custkey")
        .join(carrier, "s_suppkey", "left")
        .join(equipment, "p_partkey", "left")
    )

    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    values = {
        "load_id": key,
        "lane": F.concat("origin", F.lit(" -> "), "destination"),
        "quote_date": written("o_orderdate"),
        "book_date": written("o_orderdate"),
        "source_date": written("o_orderdate"),
        "pickup_date": written("pickup"),
        "delivery_date": written("delivery"),
        "book_price": F.col("o_totalprice"),
        "source_price": F.col("source_price"),
        "pnl": F.col("o_totalprice") - F.col("source_price"),
        "mileage": F.col("mileage"),
        "equipment_type": F.col("p_type"),
        "carrier_rating": F.col("s_suppkey") % 5 + 1,
        "sourcing_channel": F.col("o_orderpriority"),
        "vip_carrier": F.col("s_acctbal") > 5000,
        "carrier_dropped_us_count": F.col("s_suppkey") % 3,
        "carrier_name": F.col("s_name"),
        "shipper_name": F.col("c_name"),
        "carrier_on_time_to_pickup": F.col("n_lines") > 2,
        "carrier_on_time_to_delivery": F.col("n_lines") > 4,
        "carrier_on_time_overall": F.col("n_lines") > 4,
        "pickup_appointment_time": written("pickup"),
        "delivery_appointment_time": written("delivery"),
        "has_mobile_app_tracking23": key % 2 == 0,
        "has_mobile_app_tracking24": key % 3 == 0,
        "has_macropoint_tracking": key % 5 == 0,
        "has_edi_tracking": key % 7 == 0,
        "contracted_load": F.col("c_mktsegment") == "BUILDING",
        "load_booked_autonomously": status == "O",
        "load_sourced_autonomously": status == "F",
        "load_was_cancelled": status == "P",
    }
    return joined.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in RAW])


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and age of the input files: a changed input is written anew."""
    wanted = F.col("path").rlike(r"/(" + "|".join(_TABLES) + r")\.parquet")
    files = listing(spark, sf_dir).where(wanted)
    found = files.agg(F.count("*"), F.sum("length"), F.max("modified").cast("string")).first()
    return (spark.conf.get("spark.app.id", ""), sf_dir, *found)


def _once(spark: SparkSession, sf_dir: str, what: str, write: Callable[[], str]) -> str:
    """The folder ``write`` returns; written again if the input changed or the folder is gone."""
    state = (what, *_input_state(spark, sf_dir))
    if state not in _written or not _present(spark, _written[state]):
        _written[state] = write()
    return _written[state]


def _present(spark: SparkSession, folder: str) -> bool:
    try:
        listing(spark, folder)
    except AnalysisException:
        return False
    return True


def raw_drop(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the raw drop, CSV with a header, packed: as text it is the largest of all that is written."""

    def write() -> str:
        folder = shared_folder(spark, "raw")
        export_csv(loads_from_tables(spark, sf_dir), folder, compression="gzip")
        return folder

    return _once(spark, sf_dir, "raw", write)


def loads_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw drop, dates still text."""
    return read_csv(spark, raw_drop(spark, sf_dir))


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw drop with parsed dates."""
    return parse_datetimes(loads_raw(spark, sf_dir))


def staged_folder(spark: SparkSession, sf_dir: str) -> str:
    def write() -> str:
        folder = shared_folder(spark, "staged")
        ingest(spark, raw_drop(spark, sf_dir), folder, LOAD_DATE)
        return folder

    return _once(spark, sf_dir, "staged", write)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingested wide table, partitioned by load date."""
    return read_staged(spark, staged_folder(spark, sf_dir))


def star_folder(spark: SparkSession, sf_dir: str, bucketed: bool = False) -> str:
    """Folder of the star schema; ``bucketed`` places all six tables by key."""

    def write() -> str:
        source = staged_folder(spark, sf_dir)
        folder = shared_folder(spark, "star")
        buckets = bucket_count(spark, source) if bucketed else None
        materialise_star(read_staged(spark, source), star_database(folder), folder, buckets=buckets)
        return folder

    return _once(spark, sf_dir, "star_bucketed" if bucketed else "star", write)


def star_database(folder: str) -> str:
    return "star_" + folder.rsplit("-", 1)[1]


def star(spark: SparkSession, sf_dir: str, bucketed: bool = False) -> dict[str, DataFrame]:
    """The written star schema, table by table."""
    database = star_database(star_folder(spark, sf_dir, bucketed))
    return {name: spark.table(f"{database}.{name}") for name in [*DIMENSIONS, FACT]}
