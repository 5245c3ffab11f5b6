"""One query per operator.  Each takes (spark, sf_dir) and covers its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.contract import DATE_COLUMNS, KEY, RAW, REPORT_COLUMNS, STAGED
from freight.operators import (
    SALT,
    build_dimensions,
    build_fact,
    conforms,
    dedupe,
    distinct_descending,
    duplicate_profile,
    enrich_with_lanes,
    fan_out,
    flatten_star,
    key_tests,
    last_period,
    malformed_lanes,
    month_before_latest,
    not_null,
    parse_by_name_rule,
    parse_datetimes,
    parse_failure_counts,
    parse_failures,
    preview,
    read_key_index,
    repeated_since,
    row_counts,
    split_lane,
    split_text,
    unique,
    update_key_index,
)
from freight.plans import (
    hand_over_latest_drop,
    ingest,
    ingest_new_drops,
    last_month_report,
    materialise_salted_fact,
    publish_star,
    published_star,
    stage,
)
from freight.sinks import export_csv, export_csv_file, write_partitioned
from freight.sources import (
    inventory,
    read_csv,
    read_latest_csv,
    read_text_csv,
    read_staged,
    read_tables,
    read_with_drift,
    register_table,
    registered_tables,
    rejected_rows,
    stored_maxima,
    unreadable_files,
)
from freight.workspace import shared_folder
from workload.fixtures import (
    LOAD_DATE,
    loads,
    loads_raw,
    raw_drop,
    staged,
    staged_folder,
    star,
    star_database,
    star_folder,
    table,
    written,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
NEXT_LOAD_DATE = "2024-05-02"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- ingest ------------------------------------------------------------------


@query
def ingest_parse_dates(spark, sf):
    return loads(spark, sf).select(KEY, *DATE_COLUMNS)


@query
def ingest_event_times(spark, sf):
    events = table(spark, sf, "events")
    as_text = events.select("event_id", written("ts").alias("event_minute"))
    return parse_datetimes(as_text, ["event_minute"])


@query
def ingest_other_format(spark, sf):
    """A second date notation, through the general parser."""
    events = table(spark, sf, "events")
    as_text = events.select("event_id", F.date_format("ts", "yyyy.MM.dd HH:mm:ss").alias("event_second"))
    return parse_datetimes(as_text, ["event_second"], "yyyy.MM.dd HH:mm:ss")


@query
def ingest_name_rule(spark, sf):
    return parse_by_name_rule(loads_raw(spark, sf))


@query
def ingest_stamped(spark, sf):
    return stage(loads_raw(spark, sf), LOAD_DATE)


@query
def ingest_end_to_end(spark, sf):
    """The drop read, parsed, stamped, stored by load date, registered and read by name."""
    lake = shared_folder(spark, "lake")
    name = "lake_" + lake.rsplit("-", 1)[1]
    return ingest(spark, raw_drop(spark, sf), lake, LOAD_DATE, table=name)


@query
def csv_roundtrip(spark, sf):
    """Written with a header from the tables, read back under the contract."""
    return loads_raw(spark, sf)


@query
def csv_by_name(spark, sf):
    """A drop with its columns in reverse, another name for the key, and one column too many."""
    folder = shared_folder(spark, "csv")
    columns = [F.col(name).alias("shipment" if name == KEY else name) for name in reversed(RAW.names)]
    export_csv(loads_raw(spark, sf).select(F.lit("x").alias("remark"), *columns), folder)
    return read_csv(spark, folder, by_name=True, rename={"shipment": KEY})


@query
def csv_line_breaks(spark, sf):
    """Shippers and lanes with line breaks, quotes and commas inside; read by chunks of a file, not a task a file."""
    folder = shared_folder(spark, "csv")
    broken = {
        "shipper_name": F.concat("shipper_name", F.lit('\nc/o "'), F.coalesce("carrier_name", F.lit("nobody")), F.lit('",\n\nDock 1')),
        "lane": F.when(F.col("contracted_load"), F.replace("lane", F.lit(" -> "), F.lit(" ->\n"))).otherwise(F.col("lane")),
    }
    export_csv(loads_raw(spark, sf).withColumns(broken), folder)
    return read_csv(spark, folder, line_breaks=True)


@query
def csv_mixed_headers(spark, sf):
    """A drop of three kinds of files: as declared; reversed, with another name for the key; without a column, with another."""
    folder, raw = shared_folder(spark, "csv"), loads_raw(spark, sf)
    columns = [F.col(name).alias("shipment" if name == KEY else name) for name in reversed(RAW.names)]
    odd = raw.drop("mileage").withColumn("remark", F.lit("as sent"))
    parts = (raw, raw.select(*columns), odd)
    for i, part in enumerate(parts):
        key = "shipment" if "shipment" in part.columns else KEY
        export_csv(part.where(F.col(key) % 3 == i), f"{folder}/part-{i}")
    return read_csv(spark, folder, mixed_headers=True, rename={"shipment": KEY}, keep_undeclared=True)


@query
def ingest_new(spark, sf):
    """Three runs over a folder of drops: two drops, nothing new, a third drop; every load is staged once."""
    drops, lake, record = (shared_folder(spark, what) for what in ("drops", "lake", "record"))
    raw = loads_raw(spark, sf)
    third = F.col(KEY) % 3
    for i in (0, 1):
        export_csv(raw.where(third == i), f"{drops}/drop-{i}", compression="gzip")
    runs = [ingest_new_drops(spark, drops, lake, record, LOAD_DATE).where("status = 'taken'").count()]
    runs.append(ingest_new_drops(spark, drops, lake, record, NEXT_LOAD_DATE).where("status = 'taken'").count())
    export_csv(raw.where(third == 2), f"{drops}/drop-2", compression="gzip")
    runs.append(ingest_new_drops(spark, drops, lake, record, NEXT_LOAD_DATE).where("status = 'taken'").count())
    took = [F.lit(n > 0).alias(f"run_{i}_took") for i, n in enumerate(runs)]
    return read_staged(spark, lake).select(KEY, "loading_date", "delivery_date", *took)


@query
def csv_headerless_report(spark, sf):
    """The report export has no header row, so it is read back by position."""
    folder = shared_folder(spark, "csv")
    report = flatten_star(star(spark, sf))
    export_csv(report, folder, header=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    return read_csv(
        spark, folder, report.schema, header=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss"
    )


@query
def latest_drop(spark, sf):
    """Two drops of the whole table; the second, with another channel, is the one read."""
    folder = shared_folder(spark, "drops")
    raw = loads_raw(spark, sf)
    export_csv(raw, f"{folder}/drop-1")
    export_csv(raw.withColumn("sourcing_channel", F.lit("second drop")), f"{folder}/drop-2")
    return read_latest_csv(spark, folder, whole_drop=True)


def _odd_drop(spark, sf):
    """The raw drop with a column more, a column less, and prices that are no numbers."""
    price = F.when(F.col("contracted_load"), F.lit("n/a")).otherwise(F.col("book_price").cast("string"))
    return loads_raw(spark, sf).drop("equipment_type").withColumns({"book_price": price, "remark": F.lit("as sent")})


@query
def deliver_csv(spark, sf):
    """What is delivered is the drop's own columns and values; here they are read under their types."""
    folder = shared_folder(spark, "drops")
    export_csv(_odd_drop(spark, sf), f"{folder}/drop-1", compression="gzip")
    sent = hand_over_latest_drop(spark, folder, shared_folder(spark, "delivery"), compression="gzip")
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW if f.name != "equipment_type"]
    note = F.when(F.col("book_price").try_cast("double").isNull(), F.col("book_price"))
    return sent.select(*typed, "remark", note.alias("price_note"), F.lit(len(sent.columns)).alias("n_columns"))


@query
def deliver_one_file(spark, sf):
    """A drop of one file, written by many tasks; the last file below the folder is handed over as one file."""
    folder, out = shared_folder(spark, "drops"), f"{shared_folder(spark, 'delivery')}/loads.csv"
    export_csv(loads_raw(spark, sf).limit(0), f"{folder}/drop-1")
    export_csv_file(loads_raw(spark, sf), f"{folder}/drop-2/loads.csv")
    hand_over_latest_drop(spark, folder, out, whole_drop=False, single_file=True)
    return read_csv(spark, out)


@query
def ingest_undeclared(spark, sf):
    """A column that the contract does not name is staged as text; a missing one is empty."""
    folder, lake = shared_folder(spark, "csv"), shared_folder(spark, "lake")
    export_csv(_odd_drop(spark, sf), folder)
    return ingest(spark, folder, lake, LOAD_DATE, table="lake_" + lake.rsplit("-", 1)[1], undeclared="keep")


@query
def ingest_rejects(spark, sf):
    """The rows that ingest set aside, because a value did not fit its type."""
    folder, lake, rejects = (shared_folder(spark, what) for what in ("csv", "lake", "rejects"))
    export_csv(_odd_drop(spark, sf), folder)
    ingest(spark, folder, lake, LOAD_DATE, undeclared="drop", rejects=rejects)
    return spark.read.parquet(rejects).select(KEY, "book_price", "shipper_name")


@query
def delivered_misfits(spark, sf):
    """Of each column of a text drop, how many values do not fit its declared type."""
    folder = shared_folder(spark, "csv")
    export_csv(_odd_drop(spark, sf), folder)
    found = conforms(read_text_csv(spark, folder), RAW)
    return found.where("status = 'mistyped'").select("column_name", "misfits")


@query
def last_month_csv(spark, sf):
    """The report carried to its export: one month, each row once, without a header, read back."""
    folder = shared_folder(spark, "csv")
    report = last_month_report(star(spark, sf), "calendar_month")
    export_csv(report, folder, header=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    return read_csv(spark, folder, report.schema, header=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")


@query
def load_date_today(spark, sf):
    """Without a given date, rows are stamped with the day of the run."""
    stamped = stage(loads_raw(spark, sf))
    return stamped.groupBy((F.col("loading_date") == F.date_format(F.current_date(), "yyyy-MM-dd")).alias("today")).agg(
        F.count("*").alias("n_loads")
    )


def _two_load_dates(spark, sf, mode):
    folder = shared_folder(spark, f"by-date-{mode}")
    rows = loads(spark, sf)
    for day in (LOAD_DATE, NEXT_LOAD_DATE):
        write_partitioned(rows.withColumn("loading_date", F.lit(day)), folder, mode=mode)
    return (
        read_staged(spark, folder)
        .groupBy("loading_date")
        .agg(F.count("*").alias("n_loads"), F.max("delivery_date").alias("latest_delivery"))
    )


@query
def partition_write_dynamic(spark, sf):
    return _two_load_dates(spark, sf, "dynamic")


@query
def partition_write_static(spark, sf):
    return _two_load_dates(spark, sf, "static")


@query
def partition_write_many_values(spark, sf):
    """Events stored by type: many values, brought together by value before the write."""
    folder = shared_folder(spark, "by-type")
    write_partitioned(table(spark, sf, "events"), folder, by="event_type", rebalance=True)
    return spark.read.parquet(folder).groupBy("event_type").agg(
        F.count("*").alias("n_events"), F.max("value").alias("max_value")
    )


@query
def registered_table_counts(spark, sf):
    folder = staged_folder(spark, sf)
    name = "staged_" + folder.rsplit("-", 1)[1]
    return register_table(spark, name, folder).groupBy("loading_date").agg(F.count("*").alias("n_loads"))


@query
def registered_table_follows(spark, sf):
    """One name, registered on a folder, on another with a column more, and after a load date went, by what the writes report."""
    first, second = shared_folder(spark, "lake"), shared_folder(spark, "lake")
    name = "follow_" + first.rsplit("-", 1)[1]
    rows = staged(spark, sf)
    register_table(spark, name, first, written=write_partitioned(rows, first))
    noted = [rows.withColumns({"note": F.lit("new"), "loading_date": F.lit(day)}) for day in (LOAD_DATE, NEXT_LOAD_DATE)]
    wider = T.StructType([*STAGED.fields[:-1], T.StructField("note", T.StringType()), STAGED["loading_date"]])
    register_table(spark, name, second, wider, written=[write_partitioned(df, second) for df in noted])
    found = register_table(spark, name, second, wider, written=write_partitioned(noted[1], second, mode="static"))
    partitions = spark.sql(f"SHOW PARTITIONS {name}").count()
    return found.groupBy("loading_date", "note").agg(F.count("*").alias("n_loads")).withColumn("n_partitions", F.lit(partitions))


# -- lake --------------------------------------------------------------------


@query
def lake_inventory(spark, sf):
    """Tables found by folder, each with its rows and whether it holds any bytes."""
    folder = star_folder(spark, sf)
    found = inventory(spark, folder).select("table_name", (F.col("bytes") > 0).alias("has_data"))
    return found.join(row_counts(read_tables(spark, folder)), "table_name")


@query
def lake_inventory_in_tasks(spark, sf):
    """The same, with folders listed in tasks."""
    folder = star_folder(spark, sf)
    found = inventory(spark, folder, in_tasks=True).select("table_name", (F.col("bytes") > 0).alias("has_data"))
    return found.join(row_counts(read_tables(spark, folder)), "table_name")


@query
def registered_tables_counts(spark, sf):
    """The same tables found by catalog name."""
    database = star_database(star_folder(spark, sf))
    names = registered_tables(spark, database)
    return row_counts({name: spark.table(f"{database}.{name}") for name in names})


@query
def drift_union(spark, sf):
    """Three deliveries of the whole table: as declared, without a column, with a type changed."""
    folder = shared_folder(spark, "drift")
    rows = staged(spark, sf).drop("loading_date")
    rows.write.parquet(folder)
    rows.drop("pnl").write.mode("append").parquet(folder)
    rows.withColumn("carrier_rating", F.concat(F.col("carrier_rating"), F.lit("0"))).write.mode(
        "append"
    ).parquet(folder)
    return read_with_drift(spark, folder, STAGED).drop("loading_date")


@query
def drift_widening(spark, sf):
    """Whole numbers and fractions of several widths: no value changes."""
    folder = shared_folder(spark, "drift")
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    small, large = (key + 16_777_216).cast("int"), key + 9_007_199_254_740_992
    orders.select(key, small.alias("small"), large.alias("large")).write.parquet(folder)
    half = (key % 1000).cast("float") + F.lit(0.5).cast("float")
    orders.select(key, half.alias("small"), half.cast("double").alias("large")).write.mode("append").parquet(folder)
    found = read_with_drift(spark, folder)
    return found.select("o_orderkey", "small", F.col("large").cast("decimal(38,1)").alias("large"))


@query
def drift_decimal(spark, sf):
    """Prices with two digits behind the point, with five, and as whole numbers: all digits stay."""
    folder = shared_folder(spark, "drift")
    orders = table(spark, sf, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(12,2)")
    longer = price + (key % 1000).cast("decimal(3,0)") * F.lit("0.00001").cast("decimal(5,5)")
    orders.select(key, price.alias("price")).write.parquet(folder)
    orders.select(key, longer.cast("decimal(16,5)").alias("price")).write.mode("append").parquet(folder)
    orders.select(key, (key + 9_007_199_254_740_992).alias("price")).write.mode("append").parquet(folder)
    found = read_with_drift(spark, folder)
    kind = found.schema["price"].dataType.simpleString()
    return found.select("o_orderkey", F.col("price").cast("string").alias("price"), F.lit(kind).alias("price_type"))


@query
def drift_nested(spark, sf):
    """A struct, an array of structs and a date; the second delivery has other fields, wider numbers and times of day."""
    folder = shared_folder(spark, "drift")
    orders = table(spark, sf, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    small, cents = (key % 100).cast("int"), F.col("o_totalprice").cast("decimal(12,2)")
    one = {
        "place": F.struct(F.col("o_orderstatus").alias("city"), small.alias("zip")),
        "items": F.array(F.struct(small.alias("n"), F.col("o_orderpriority").alias("kind")), F.struct((small + 1).alias("n"), F.lit(None).cast("string").alias("kind"))),
        "shipped": day.cast("date"),
    }
    two = {
        "place": F.when(key % 3 > 0, F.struct(key.alias("ZIP"), F.col("o_orderpriority").alias("state"))),
        "items": F.array(F.struct(key.alias("n"), cents.alias("price"))),
        "shipped": day + F.make_dt_interval(hours=(key % 24).cast("int")),
    }
    for values in (one, two):
        orders.select(key, *(value.alias(name) for name, value in values.items())).write.mode("append").parquet(folder)
    found = read_with_drift(spark, folder)
    parts = [F.col(f"place.{name}").alias(name) for name in ("city", "zip", "state")]
    item = F.transform("items", lambda x: F.concat_ws("/", x["n"], F.coalesce(x["kind"], F.lit("-")), F.coalesce(x["price"].cast("string"), F.lit("-"))))
    return found.select("o_orderkey", F.col("place").isNull().alias("no_place"), *parts, F.array_join(item, ";").alias("items"), "shipped")


@query
def drift_case(spark, sf):
    """A column whose name changes case between files, one of which has another type."""
    folder = shared_folder(spark, "drift")
    rows = staged(spark, sf).select(KEY, "pnl")
    rows.write.parquet(folder)
    rows.withColumnRenamed("pnl", "PNL").write.mode("append").parquet(folder)
    rows.select(F.col(KEY).cast("string").alias(KEY), "pnl").write.mode("append").parquet(folder)
    return read_with_drift(spark, folder).select(F.col(KEY).cast("bigint").alias(KEY), "pnl")


@query
def drift_missing_column(spark, sf):
    """Added and missing columns only: Spark's own schema merge is enough."""
    folder = shared_folder(spark, "drift")
    rows = staged(spark, sf).select(KEY, "lane", "pnl")
    rows.drop("pnl").write.parquet(folder)
    rows.drop("lane").write.mode("append").parquet(folder)
    return read_with_drift(spark, folder)


@query
def drift_unreadable(spark, sf):
    """CSV text left among the Parquet files: skipped by the read, listed by the check."""
    folder = shared_folder(spark, "drift")
    rows = staged(spark, sf).select(KEY, "shipper_name")
    rows.write.parquet(folder)
    rows.write.mode("append").csv(folder)
    found = unreadable_files(spark, folder).agg(F.count("*") > 0).scalar()
    return read_with_drift(spark, folder).withColumn("found_unreadable", found)


@query
def strict_union(spark, sf):
    """Same columns in another order; rows are kept with their copies."""
    rows = staged(spark, sf).select(KEY, "lane", "book_price")
    return rows.unionByName(rows.select("book_price", KEY, "lane"))


# -- lanes -------------------------------------------------------------------


@query
def lane_split(spark, sf):
    return split_lane(staged(spark, sf)).drop("split_column")


@query
def lane_ends(spark, sf):
    """The generic text split, and the array that the lane split leaves behind."""
    names = ["first", "second", "third"]
    ends = split_text(staged(spark, sf), "lane", " -> ", names)
    return split_lane(ends, [KEY, *names]).select(
        KEY, *names, F.array_size("split_column").cast("bigint").alias("n_ends")
    )


@query
def lane_enriched(spark, sf):
    return enrich_with_lanes(staged(spark, sf), mode="join")


@query
def lane_enriched_single(spark, sf):
    return enrich_with_lanes(staged(spark, sf), mode="single")


# -- star schema -------------------------------------------------------------


def _dimension(name: str) -> Query:
    return lambda spark, sf: build_dimensions(staged(spark, sf))[name]


for _name in ("dim_book", "dim_carriers", "dim_delivery", "dim_pickup", "dim_shippers"):
    QUERIES[_name] = _dimension(_name)


@query
def fact_join(spark, sf):
    return build_fact(staged(spark, sf), mode="join")


@query
def fact_single(spark, sf):
    return build_fact(staged(spark, sf), mode="single")


def _unkeyed(spark, sf):
    """The staged table with a third of its rows, the cancelled loads, without a key."""
    key = F.when(F.col("load_was_cancelled"), None).otherwise(F.col(KEY))
    return staged(spark, sf).withColumn(KEY, key)


@query
def fact_join_null_keys(spark, sf):
    return build_fact(_unkeyed(spark, sf), mode="join")


@query
def fact_single_null_keys(spark, sf):
    return build_fact(_unkeyed(spark, sf), mode="single")


@query
def fact_join_duplicates(spark, sf):
    """Every load delivered twice: the joins return 64 copies, counted here instead of made."""
    rows = staged(spark, sf)
    return build_fact(rows.unionAll(rows), mode="counted")


@query
def fact_counted_null_keys(spark, sf):
    return build_fact(_unkeyed(spark, sf), mode="counted")


def _hot(spark, sf):
    """Loads of which the cancelled ones all have the key -1, and dimensions with one row for each key."""
    rows = staged(spark, sf)
    cancelled = F.col("load_was_cancelled")
    one = rows.where(cancelled).agg(F.min(KEY)).scalar()
    single = rows.where(~cancelled | (F.col(KEY) == one))
    key = F.when(cancelled, F.lit(-1).cast("long")).otherwise(F.col(KEY))
    return rows.withColumn(KEY, key), build_dimensions(single.withColumn(KEY, key))


@query
def fact_hot_key(spark, sf):
    """One key holds a large part of all rows; its rows are spread over many tasks of every join."""
    rows, dimensions = _hot(spark, sf)
    return build_fact(rows, dimensions, mode="join", hot_parts=64)


@query
def fact_hot_key_bucketed(spark, sf):
    """The same from tables bucketed by key and salt."""
    rows, dimensions = _hot(spark, sf)
    folder = shared_folder(spark, "salted")
    return materialise_salted_fact(rows, dimensions, star_database(folder), folder, buckets=16).drop(SALT)


@query
def star_tables(spark, sf):
    """The written star, counted table by table."""
    return row_counts(star(spark, sf))


@query
def star_published(spark, sf):
    """A star of few loads is published, then one of all; counted as a reader finds it."""
    rows, folder = staged(spark, sf), shared_folder(spark, "published")
    database = "published_" + folder.rsplit("-", 1)[1]
    publish_star(rows.where(F.col(KEY) % 2 == 0), database, folder)
    publish_star(rows, database, folder)
    return row_counts(published_star(spark, database))


@query
def fact_written(spark, sf):
    """Every column of the fact as stored."""
    return star(spark, sf)["fact_loads"]


def _written_dimension(name: str) -> Query:
    return lambda spark, sf: star(spark, sf, bucketed=True)[name]


for _name in ("dim_book", "dim_carriers", "dim_delivery", "dim_pickup", "dim_shippers"):
    QUERIES[f"{_name}_written"] = _written_dimension(_name)


@query
def column_comments(spark, sf):
    """The comments that the catalog has for the columns of the stored star."""
    database = star_database(star_folder(spark, sf))
    rows = [
        (name, field.name, field.metadata.get("comment"))
        for name in registered_tables(spark, database)
        for field in spark.table(f"{database}.{name}").schema
    ]
    described = spark.createDataFrame(rows, "table_name string, column_name string, comment string")
    return described.join(row_counts(star(spark, sf)), "table_name")


@query
def fact_from_tables(spark, sf):
    """The fact as joined from dimensions that were written as bucketed tables."""
    return build_fact(staged(spark, sf), star(spark, sf, bucketed=True), mode="join")


# -- report ------------------------------------------------------------------


@query
def star_flat(spark, sf):
    return flatten_star(star(spark, sf))


@query
def star_flat_bucketed(spark, sf):
    return flatten_star(star(spark, sf, bucketed=True))


@query
def delivery_dates(spark, sf):
    return distinct_descending(flatten_star(star(spark, sf, bucketed=True)), "delivery_date")


@query
def latest_delivery(spark, sf):
    return month_before_latest(flatten_star(star(spark, sf, bucketed=True)), "delivery_date")


@query
def latest_delivery_by_statistics(spark, sf):
    """The same from the footers of the written dimension, without reading its rows."""
    folder = f"{star_folder(spark, sf)}/dim_delivery"
    return month_before_latest(stored_maxima(spark, folder, "delivery_date", STAGED["delivery_date"].dataType), "delivery_date")


@query
def last_month_instant(spark, sf):
    return last_month_report(star(spark, sf), "instant", keys_checked=True)


@query
def last_month_day(spark, sf):
    return last_month_report(star(spark, sf), "day", keys_checked=True)


@query
def last_month_calendar(spark, sf):
    return last_month_report(star(spark, sf), "calendar_month", keys_checked=True)


@query
def last_month_bucketed(spark, sf):
    return last_month_report(star(spark, sf, bucketed=True), "calendar_month", keys_checked=True)


@query
def last_month_repeated_keys(spark, sf):
    """Every table of the star delivered twice: the plain joins would give 64 copies."""
    twice = {name: df.unionAll(df) for name, df in star(spark, sf).items()}
    return last_month_report(twice, "calendar_month")


@query
def last_month_unchecked(spark, sf):
    """Nothing is known of the keys; copies, had there been any, would go."""
    return last_month_report(star(spark, sf), "calendar_month")


@query
def last_month_of_orders(spark, sf):
    """The period filter on a plain table: by day and by calendar month."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    days = last_period(orders, "o_orderdate", "day").withColumn("period", F.lit("day"))
    months = last_period(orders, "o_orderdate", "calendar_month").withColumn("period", F.lit("month"))
    return days.unionByName(months)


@query
def report_dedup(spark, sf):
    """The report rows delivered twice, then each kept once."""
    rows = flatten_star(star(spark, sf, bucketed=True))
    return dedupe(rows.unionAll(rows)).select(*REPORT_COLUMNS)


QUERIES["duplicate_profile"] = lambda spark, sf: duplicate_profile(
    table(spark, sf, "lineitem"), "l_orderkey"
)


@query
def table_counts(spark, sf):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    return row_counts({name: table(spark, sf, name) for name in names})


@query
def first_loads(spark, sf):
    return preview(staged(spark, sf), "loads_preview", rows=10, order_by=KEY)


# -- quality -----------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    return not_null(staged(spark, sf), "lane").select(KEY, "shipper_name")


@query
def dq_unique(spark, sf):
    return unique(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query
def dq_unique_key(spark, sf):
    """The loads whose order was cancelled come twice."""
    rows = staged(spark, sf)
    return unique(rows.unionAll(rows.where("load_was_cancelled")))


@query
def dq_unique_by_date(spark, sf):
    """Every load on one of two load dates, the cancelled ones of even keys on both; the second date is checked by bitmaps."""
    folder, index = shared_folder(spark, "lake"), shared_folder(spark, "keys")
    rows = staged(spark, sf).select(KEY, "loading_date", "load_was_cancelled")
    even = F.col(KEY) % 2 == 0
    for day, some in ((LOAD_DATE, even), (NEXT_LOAD_DATE, ~even | F.col("load_was_cancelled"))):
        write_partitioned(rows.where(some).withColumn("loading_date", F.lit(day)), folder)
        arrived = spark.read.schema(rows.schema).parquet(folder).where(F.col("loading_date") == day)
        update_key_index(arrived, index)
    loads_ = spark.read.schema(rows.schema).parquet(folder)
    return repeated_since(loads_, read_key_index(spark, index), NEXT_LOAD_DATE)


@query
def dq_key_tests(spark, sf):
    return key_tests(table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", KEY))


@query
def dq_fan_out(spark, sf):
    return fan_out(table(spark, sf, "lineitem"), "l_orderkey")


@query
def dq_parse_failures(spark, sf):
    """Event times written in four notations, of which one is the declared one."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(written("ts"), F.lit(":59")))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(kind == "error", F.lit("  "))
        .otherwise(written("ts"))
    )
    events = table(spark, sf, "events").select("event_id", "event_type", text.alias("written"))
    return parse_failures(events, "written")


@query
def dq_parse_failure_counts(spark, sf):
    """A date column, and two text columns taken for dates."""
    return parse_failure_counts(loads_raw(spark, sf), ["delivery_date", "sourcing_channel", "lane"])


@query
def dq_malformed_lanes(spark, sf):
    """Lanes that lose their delivery state, or gain a third end, on some loads."""
    lane = (
        F.when(F.col("load_was_cancelled"), F.regexp_replace("lane", ",[^,]*$", ""))
        .when(F.col("contracted_load"), F.concat("lane", F.lit(" -> X,Y")))
        .otherwise(F.col("lane"))
    )
    return malformed_lanes(staged(spark, sf).select(KEY, lane.alias("lane")))


@query
def dq_contract(spark, sf):
    """The raw drop against the staged contract: dates still text, no load date yet."""
    return conforms(loads_raw(spark, sf).withColumn("note", F.lit("x")), STAGED)


@query
def dq_rejected_rows(spark, sf):
    """CSV rows with a value that does not fit: ratings written as words on VIP loads."""
    folder = shared_folder(spark, "csv")
    rating = F.when(F.col("vip_carrier"), F.lit("high")).otherwise(F.col("carrier_rating").cast("string"))
    export_csv(loads_raw(spark, sf).withColumn("carrier_rating", rating), folder)
    rows = read_csv(spark, folder, RAW, keep_rejected=True)
    return rejected_rows(rows).select(KEY, "carrier_rating", "shipper_name")
