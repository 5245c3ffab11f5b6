"""The SQL that each query is checked against, for DuckDB over the same tables."""

from __future__ import annotations

from freight.contract import COMMENTS, DATE_COLUMNS, DIMENSIONS, FACT_COLUMNS, FACT_SOURCES, RAW, REPORT_SOURCES
from workload.fixtures import LOAD_DATE
from workload.queries import NEXT_LOAD_DATE

_WRITTEN = "strftime({}, '%-m/%-d/%Y %-H:%M')"

# The raw drop: one load per order, dates as text.
_RAW = f"""
with trip as (
  select l_orderkey, min(l_suppkey) as suppkey, min(l_partkey) as partkey,
         min(l_shipdate) as pickup, max(l_shipdate) as delivery,
         max(l_extendedprice) as source_price, sum(l_quantity) as mileage, count(*) as n_lines
  from lineitem group by l_orderkey),
raw as (
  select o.o_orderkey as load_id,
    sn.n_name || ',' || sr.r_name || ' -> ' || cn.n_name || ',' || cr.r_name as lane,
    {_WRITTEN.format('o.o_orderdate')} as quote_date,
    {_WRITTEN.format('o.o_orderdate')} as book_date,
    {_WRITTEN.format('o.o_orderdate')} as source_date,
    {_WRITTEN.format('t.pickup')} as pickup_date,
    {_WRITTEN.format('t.delivery')} as delivery_date,
    o.o_totalprice as book_price, t.source_price, o.o_totalprice - t.source_price as pnl, t.mileage,
    p.p_type as equipment_type, cast(s.s_suppkey % 5 + 1 as int) as carrier_rating,
    o.o_orderpriority as sourcing_channel, s.s_acctbal > 5000 as vip_carrier,
    cast(s.s_suppkey % 3 as int) as carrier_dropped_us_count, s.s_name as carrier_name,
    c.c_name as shipper_name, t.n_lines > 2 as carrier_on_time_to_pickup,
    t.n_lines > 4 as carrier_on_time_to_delivery, t.n_lines > 4 as carrier_on_time_overall,
    {_WRITTEN.format('t.pickup')} as pickup_appointment_time,
    {_WRITTEN.format('t.delivery')} as delivery_appointment_time,
    o.o_orderkey % 2 = 0 as has_mobile_app_tracking23, o.o_orderkey % 3 = 0 as has_mobile_app_tracking24,
    o.o_orderkey % 5 = 0 as has_macropoint_tracking, o.o_orderkey % 7 = 0 as has_edi_tracking,
    c.c_mktsegment = 'BUILDING' as contracted_load, o.o_orderstatus = 'O' as load_booked_autonomously,
    o.o_orderstatus = 'F' as load_sourced_autonomously, o.o_orderstatus = 'P' as load_was_cancelled
  from orders o
  join customer c on o.o_custkey = c.c_custkey
  join nation cn on c.c_nationkey = cn.n_nationkey join region cr on cn.n_regionkey = cr.r_regionkey
  left join trip t on o.o_orderkey = t.l_orderkey
  left join supplier s on t.suppkey = s.s_suppkey left join part p on t.partkey = p.p_partkey
  left join nation sn on s.s_nationkey = sn.n_nationkey left join region sr on sn.n_regionkey = sr.r_regionkey)
"""

_PARSED = [
    f"try_strptime(trim({name}), '%m/%d/%Y %H:%M') as {name}" if name in DATE_COLUMNS else name
    for name in RAW.names
]
# The staged table without its load date.
_LOADS = f"{_RAW}, loads as (select {', '.join(_PARSED)} from raw)"

_PIECE = "string_split(string_split(lane, ' -> ')[{}], ',')[{}]"
_PIECES = {
    "pickup_city": _PIECE.format(1, 1),
    "pickup_state": _PIECE.format(1, 2),
    "delivery_city": _PIECE.format(2, 1),
    "delivery_state": _PIECE.format(2, 2),
}


def _dimension(name: str, source: str = "loads") -> str:
    columns = [f"{_PIECES[c]} as {c}" if c in _PIECES else c for c in DIMENSIONS[name]]
    return f"select {', '.join(columns)} from {source}"


def _fact(source: str = "loads", slices: str | None = None) -> str:
    """Five left joins of the source to its slices, or to those of another table."""
    columns = ", ".join(f"{d}.{c}" for d, names in FACT_SOURCES.items() for c in names)
    joins = " ".join(
        f"left join ({_dimension(d, slices or source)}) {d} on source.load_id = {d}.load_id" for d in FACT_SOURCES
    )
    return f"select source.load_id, {columns} from {source} as source {joins}"


_FLAT_COLUMNS = ", ".join(f"{table}.{column}" for column, table in REPORT_SOURCES)
_FLAT_JOINS = " ".join(
    f"join ({_dimension(d)}) {d} on fact.load_id = {d}.load_id" for d in DIMENSIONS
)
_FLAT = f"{_LOADS}, flat as (select fact.load_id, {_FLAT_COLUMNS} from ({_fact()}) fact {_FLAT_JOINS})"

# The day one month before the latest delivery.
_MONTH_EARLIER = "(select cast(max(delivery_date) as date) - interval 1 month from flat)"
_HOT = f"""{_LOADS}, hot as (select * replace (case when load_was_cancelled then -1 else load_id end as load_id) from loads),
single as (select * replace (case when load_was_cancelled then -1 else load_id end as load_id) from loads
  where not load_was_cancelled or load_id = (select min(load_id) from loads where load_was_cancelled))"""
_UNKEYED = (
    f"{_LOADS}, unkeyed as (select * replace "
    "(case when load_was_cancelled then null else load_id end as load_id) from loads)"
)
_ENRICHED = f"{_LOADS} select *, " + ", ".join(f"{e} as {n}" for n, e in _PIECES.items()) + " from loads"
_RAW_ROWS = f"{_RAW} select * from raw"
_STAGED_ROWS = f"{_LOADS} select *, '{LOAD_DATE}' as loading_date from loads"
_ENRICHED_STAGED = _ENRICHED.replace("select *, ", f"select *, '{LOAD_DATE}' as loading_date, ")
_STAR_COUNTS = (
    "select t.table_name, (select count(*) from orders) as n_rows{extra} from (values "
    + ", ".join(f"('{name}')" for name in [*DIMENSIONS, "fact_loads"])
    + ") t(table_name)"
)


def _by_load_date(days: list[str]) -> str:
    parts = [
        f"select '{day}' as loading_date, count(*) as n_loads, max(delivery_date) as latest_delivery from loads"
        for day in days
    ]
    return f"{_LOADS} " + " union all ".join(parts)


def _month_of_flat(condition: str) -> str:
    return f"{_FLAT} select distinct * from flat where {condition.format(day=_MONTH_EARLIER)}"


_CALENDAR_MONTH = "date_trunc('month', delivery_date) = date_trunc('month', {day})"
_ORDER_DAY = "(select cast(max(o_orderdate) as date) - interval 1 month from orders)"

_CONTRACT_COLUMNS = [
    *[
        f"('{f.name}', 'timestamp_ntz', 'string', 'mistyped', (select count({f.name}) from raw))"
        if f.name in DATE_COLUMNS
        else f"('{f.name}', '{f.dataType.simpleString()}', '{f.dataType.simpleString()}', 'ok', 0)"
        for f in RAW
    ],
    "('loading_date', 'string', null, 'missing', (select count(*) from raw))",
    "('note', null, 'string', 'extra', 0)",
]

ORACLES: dict[str, str] = {
    "ingest_parse_dates": f"{_LOADS} select load_id, {', '.join(DATE_COLUMNS)} from loads",
    "ingest_event_times": "select event_id, date_trunc('minute', ts) as event_minute from events",
    "ingest_other_format": "select event_id, date_trunc('second', ts) as event_second from events",
    "ingest_name_rule": f"{_LOADS} select * from loads",
    "ingest_stamped": _STAGED_ROWS,
    "ingest_end_to_end": _STAGED_ROWS,
    "csv_roundtrip": _RAW_ROWS,
    "csv_by_name": _RAW_ROWS,
    "csv_line_breaks": (
        f"{_RAW} select * replace (shipper_name || chr(10) || 'c/o \"' || coalesce(carrier_name, 'nobody') || '\",' || chr(10) || chr(10) "
        "|| 'Dock 1' as shipper_name, case when contracted_load then replace(lane, ' -> ', ' ->' || chr(10)) else lane end as lane) from raw"
    ),
    "csv_mixed_headers": (
        f"{_RAW} select * replace (case when load_id % 3 < 2 then mileage end as mileage), "
        "case when load_id % 3 = 2 then 'as sent' end as remark from raw"
    ),
    "ingest_new": (
        f"{_LOADS} select load_id, case when load_id % 3 = 2 then '{NEXT_LOAD_DATE}' else '{LOAD_DATE}' end as loading_date, "
        "delivery_date, true as run_0_took, false as run_1_took, true as run_2_took from loads"
    ),
    "csv_headerless_report": f"{_FLAT} select * from flat",
    "latest_drop": f"{_RAW} select * replace ('second drop' as sourcing_channel) from raw",
    "deliver_csv": (
        f"{_RAW} select * exclude (equipment_type) replace (case when not contracted_load then book_price end as book_price), "
        "'as sent' as remark, case when contracted_load then 'n/a' end as price_note, 31 as n_columns from raw"
    ),
    "deliver_one_file": _RAW_ROWS,
    "ingest_undeclared": (
        f"{_LOADS} select * replace (case when not contracted_load then book_price end as book_price, "
        f"null::varchar as equipment_type), 'as sent' as remark, '{LOAD_DATE}' as loading_date from loads"
    ),
    "ingest_rejects": f"{_RAW} select load_id, cast(null as double) as book_price, shipper_name from raw where contracted_load",
    "delivered_misfits": (
        f"{_RAW} "
        + " union all ".join(
            f"select '{f.name}' as column_name, "
            + (f"count(*) filter ({'contracted_load' if f.name == 'book_price' else 'false'})")
            + " as misfits from raw"
            for f in RAW
            if f.dataType.simpleString() != "string"
        )
    ),
    "last_month_csv": _month_of_flat(_CALENDAR_MONTH),
    "load_date_today": "select true as today, count(*) as n_loads from orders",
    "registered_table_follows": (
        f"select '{NEXT_LOAD_DATE}' as loading_date, 'new' as note, count(*) as n_loads, 1 as n_partitions from orders"
    ),
    "drift_widening": (
        "select o_orderkey, cast(o_orderkey + 16777216 as double) as small, "
        "cast(o_orderkey + 9007199254740992 as decimal(38,1)) as large from orders union all "
        "select o_orderkey, o_orderkey % 1000 + 0.5::double as small, "
        "cast(o_orderkey % 1000 + 0.5 as decimal(38,1)) as large from orders"
    ),
    "dq_unique_by_date": (
        f"{_LOADS} select load_id, count(*) as n_records from (select load_id from loads where load_id % 2 = 0 "
        "union all select load_id from loads where load_id % 2 = 1 or load_was_cancelled) group by load_id having count(*) > 1"
    ),
    "drift_decimal": (
        "with p as (select o_orderkey as k, cast(o_totalprice as decimal(12,2)) as price from orders) "
        "select k as o_orderkey, cast(cast(price as decimal(24,5)) as varchar) as price, 'decimal(24,5)' as price_type from p union all "
        "select k, cast(cast(price + (k % 1000) * cast(0.00001 as decimal(5,5)) as decimal(24,5)) as varchar), 'decimal(24,5)' from p union all "
        "select k, cast(k + 9007199254740992 as varchar) || '.00000', 'decimal(24,5)' from p"
    ),
    "drift_nested": (
        "select o_orderkey, false as no_place, o_orderstatus as city, o_orderkey % 100 as zip, null as state, "
        "(o_orderkey % 100) || '/' || o_orderpriority || '/-;' || (o_orderkey % 100 + 1) || '/-/-' as items, "
        "cast(cast(o_orderdate as date) as timestamp) as shipped from orders union all "
        "select o_orderkey, o_orderkey % 3 = 0, null, case when o_orderkey % 3 > 0 then o_orderkey end, case when o_orderkey % 3 > 0 then o_orderpriority end, "
        "o_orderkey || '/-/' || cast(o_totalprice as decimal(12,2)), cast(o_orderdate as timestamp) + to_hours(cast(o_orderkey % 24 as integer)) from orders"
    ),
    "drift_case": " union all ".join([f"select load_id, pnl from ({_LOADS} select load_id, pnl from loads)"] * 3),
    "fact_written": f"{_LOADS} {_fact()}",
    **{f"{name}_written": f"{_LOADS} {_dimension(name)}" for name in DIMENSIONS},
    "column_comments": (
        "select t.table_name, t.column_name, t.comment, (select count(*) from orders) as n_rows from (values "
        + ", ".join(
            "('{}', '{}', '{}')".format(table, column, COMMENTS[column].replace("'", "''"))
            for table, columns in [*DIMENSIONS.items(), ("fact_loads", FACT_COLUMNS)]
            for column in columns
        )
        + ") t(table_name, column_name, comment)"
    ),
    "partition_write_dynamic": _by_load_date([LOAD_DATE, NEXT_LOAD_DATE]),
    "partition_write_static": _by_load_date([NEXT_LOAD_DATE]),
    "partition_write_many_values": (
        "select event_type, count(*) as n_events, max(value) as max_value from events group by event_type"
    ),
    "registered_table_counts": f"select '{LOAD_DATE}' as loading_date, count(*) as n_loads from orders",
    "lake_inventory": _STAR_COUNTS.format(extra=", true as has_data"),
    "lake_inventory_in_tasks": _STAR_COUNTS.format(extra=", true as has_data"),
    "registered_tables_counts": _STAR_COUNTS.format(extra=""),
    "drift_union": (
        f"{_LOADS} select * from loads union all by name select * exclude (pnl) from loads "
        "union all by name select * replace (carrier_rating * 10 as carrier_rating) from loads"
    ),
    "drift_missing_column": (
        f"{_LOADS} select load_id, lane from loads union all by name select load_id, pnl from loads"
    ),
    "drift_unreadable": f"{_LOADS} select load_id, shipper_name, true as found_unreadable from loads",
    "strict_union": (
        f"{_LOADS} select load_id, lane, book_price from loads "
        "union all by name select book_price, load_id, lane from loads"
    ),
    "lane_split": (
        f"{_LOADS} select load_id, lane, string_split(lane, ' -> ')[1] as origin, "
        "string_split(lane, ' -> ')[2] as destination, "
        + ", ".join(f"{e} as {n}" for n, e in _PIECES.items())
        + " from loads"
    ),
    "lane_ends": (
        f"{_LOADS} select load_id, string_split(lane, ' -> ')[1] as first, "
        "string_split(lane, ' -> ')[2] as second, string_split(lane, ' -> ')[3] as third, "
        "len(string_split(lane, ' -> ')) as n_ends from loads"
    ),
    "lane_enriched": _ENRICHED_STAGED,
    "lane_enriched_single": _ENRICHED_STAGED,
    **{name: f"{_LOADS} {_dimension(name)}" for name in DIMENSIONS},
    "fact_join": f"{_LOADS} {_fact()}",
    "fact_single": f"{_LOADS} {_fact()}",
    "fact_join_null_keys": f"{_UNKEYED} {_fact('unkeyed')}",
    "fact_single_null_keys": f"{_UNKEYED} {_fact('unkeyed')}",
    "fact_join_duplicates": (
        f"{_LOADS}, twice as (select * from loads union all select * from loads) "
        f"select *, cast(count(*) as decimal(38,0)) as copies from ({_fact('twice')}) group by all"
    ),
    "fact_counted_null_keys": (
        f"{_UNKEYED} select *, cast(count(*) as decimal(38,0)) as copies from ({_fact('unkeyed')}) group by all"
    ),
    "fact_from_tables": f"{_LOADS} {_fact()}",
    "fact_hot_key": f"{_HOT} {_fact('hot', 'single')}",
    "fact_hot_key_bucketed": f"{_HOT} {_fact('hot', 'single')}",
    "star_tables": _STAR_COUNTS.format(extra=""),
    "star_published": _STAR_COUNTS.format(extra=""),
    "star_flat": f"{_FLAT} select * from flat",
    "star_flat_bucketed": f"{_FLAT} select * from flat",
    "delivery_dates": f"{_FLAT} select distinct delivery_date from flat order by delivery_date desc",
    "latest_delivery": (
        f"{_FLAT} select max(delivery_date) as latest, "
        "cast(cast(max(delivery_date) as date) - interval 1 month as date) as month_earlier, "
        "cast(max(delivery_date) as date) - interval 1 month as month_earlier_at from flat"
    ),
    "latest_delivery_by_statistics": (
        f"{_FLAT} select max(delivery_date) as latest, "
        "cast(cast(max(delivery_date) as date) - interval 1 month as date) as month_earlier, "
        "cast(max(delivery_date) as date) - interval 1 month as month_earlier_at from flat"
    ),
    "last_month_instant": _month_of_flat("delivery_date = {day}"),
    "last_month_day": _month_of_flat("cast(delivery_date as date) = cast({day} as date)"),
    "last_month_calendar": _month_of_flat(_CALENDAR_MONTH),
    "last_month_bucketed": _month_of_flat(_CALENDAR_MONTH),
    "last_month_repeated_keys": _month_of_flat(_CALENDAR_MONTH),
    "last_month_unchecked": _month_of_flat(_CALENDAR_MONTH),
    "last_month_of_orders": (
        "select o_orderkey, o_orderdate, 'day' as period from orders "
        f"where cast(o_orderdate as date) = cast({_ORDER_DAY} as date) union all "
        "select o_orderkey, o_orderdate, 'month' as period from orders "
        f"where date_trunc('month', o_orderdate) = date_trunc('month', {_ORDER_DAY})"
    ),
    "report_dedup": f"{_FLAT} select distinct * from (select * from flat union all select * from flat)",
    "duplicate_profile": (
        "select l_orderkey, count(*) as total from lineitem group by l_orderkey "
        "order by total desc, l_orderkey"
    ),
    "table_counts": " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows from {name}"
        for name in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    ),
    "first_loads": f"{_STAGED_ROWS} order by load_id limit 10",
    "dq_not_null": f"{_LOADS} select load_id, shipper_name from loads where lane is null",
    "dq_unique": (
        "select l_orderkey, l_linenumber, count(*) as n_records from lineitem "
        "where l_orderkey is not null and l_linenumber is not null "
        "group by l_orderkey, l_linenumber having count(*) > 1"
    ),
    "dq_unique_key": (
        f"{_LOADS} select load_id, count(*) as n_records from "
        "(select * from loads union all select * from loads where load_was_cancelled) "
        "where load_id is not null group by load_id having count(*) > 1"
    ),
    "dq_key_tests": (
        "select 'not_null' as test, count(*) as failures from lineitem where l_orderkey is null union all "
        "select 'unique' as test, count(*) as failures from "
        "(select l_orderkey from lineitem where l_orderkey is not null group by l_orderkey having count(*) > 1)"
    ),
    "dq_fan_out": (
        "select l_orderkey, total, n * n * n * n * n * n as joined_rows from "
        "(select l_orderkey, count(*) as total, cast(count(*) as double) as n from lineitem "
        "where l_orderkey is not null group by l_orderkey having count(*) > 1)"
    ),
    "dq_parse_failures": (
        "with written as (select event_id, event_type, case event_type "
        "when 'click' then strftime(ts, '%-m/%-d/%Y %-H:%M') || ':59' "
        "when 'view' then strftime(ts, '%Y-%m-%d %H:%M') when 'error' then '  ' "
        "else strftime(ts, '%-m/%-d/%Y %-H:%M') end as written from events) "
        "select * from written where trim(written) <> '' "
        "and try_strptime(trim(written), '%m/%d/%Y %H:%M') is null"
    ),
    "dq_parse_failure_counts": (
        f"{_RAW} "
        + " union all ".join(
            f"select '{c}' as column_name, count(*) filter (trim({c}) <> '' and "
            f"try_strptime(trim({c}), '%m/%d/%Y %H:%M') is null) as failures from raw"
            for c in ["delivery_date", "sourcing_channel", "lane"]
        )
    ),
    "dq_malformed_lanes": (
        f"{_LOADS} select load_id, lane from (select load_id, case "
        "when load_was_cancelled then regexp_replace(lane, ',[^,]*$', '') "
        "when contracted_load then lane || ' -> X,Y' else lane end as lane from loads) "
        "where lane is not null and not regexp_full_match(lane, '[^,]*,[^,]* -> [^,]*,[^,]*')"
    ),
    "dq_contract": (
        f"{_RAW} select * from (values {', '.join(_CONTRACT_COLUMNS)}) "
        "t(column_name, declared_type, found_type, status, misfits)"
    ),
    "dq_rejected_rows": (
        f"{_RAW} select load_id, cast(null as int) as carrier_rating, shipper_name from raw where vip_carrier"
    ),
}

