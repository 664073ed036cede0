"""Schedule data derived from the test tables, as SQL that Spark and DuckDB both read.

Orders are trips, line items their stop times, suppliers are stops, customers routes,
nations lines and municipalities, and the users active on a weekday make the calendar.
Every row of a base table is used: a view adds values the schedule domain has and the
tables lack (missing values, sentinels, copies, several extraction days), and drops none.
"""

from __future__ import annotations

import re
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from headway.schemas import feed_schema

#: Tables whose rows become several rows of some seventy columns: dealt to tasks by so many bytes of their files
#: before, as what a task then holds is a hundred times what it reads.
WIDENED, WIDENED_BYTES = ("customer", "supplier"), 1024 * 1024

BASE_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

# Unnesting is the one construct the two dialects spell differently.
UNNEST = {"spark": "explode(array({}))", "duckdb": "unnest([{}])"}
TWO_DAYS = "'20240101', '20240102'"
THREE_DAYS = "'20240101', '20240102', '20240103'"

DAY = (
    "cast(concat(substr({0}, 1, 4), '-', substr({0}, 5, 2), '-', substr({0}, 7, 2)) as date)"
)


def _two_digits(number: str) -> str:
    return f"lpad(cast({number} as string), 2, '0')"


def _filler(table: str, key: str, given: dict[str, str]) -> str:
    """A value for every column of a feed table: as given, or a mix of usual and odd values."""
    values = []
    for i, field in enumerate(feed_schema(table)):
        kind = field.dataType.simpleString()
        value = given.get(field.name) or {
            "string": f"case ({key} + {i}) % 6 when 0 then null when 1 then 'NaN' "
            f"when 2 then 'UNKNOWN' when 3 then 'no NaN here' else 'yes' end",
            "bigint": f"cast(({key} + {i}) % 2 as bigint)",
            "double": f"case ({key} + {i}) % 4 when 0 then null when 1 then cast('NaN' as double) "
            f"else (({key} + {i}) % 9) * 0.25E0 end",
        }[kind]
        values.append(f"{value} {field.name}")
    return ",\n       ".join(values)


STOP_ID_LIST = """
    case when s_suppkey % 7 = 0 then 'UNKNOWN' when s_suppkey % 7 = 1 then '[]'
         when s_suppkey % 7 = 2 then null when s_suppkey % 7 = 3 then '["broken'
         else concat('["L', cast(s_nationkey as string), '","L', cast(s_suppkey % 3 as string), '"]')
    end"""
ROUTE_ID_LIST = """concat('["', c_mktsegment, '","é', cast(c_nationkey as string), '"]')"""

INPUTS = {
    # -- the schedule of one extraction day, staged and clean ------------------------------
    "trips": """
        select cast(o_orderkey as string) trip_id, cast(o_custkey as string) route_id,
               concat('S', cast(o_orderkey % 6 as string)) service_id,
               concat('P', cast(o_orderkey % 40 as string)) pattern_id,
               concat('SH', cast(o_orderkey % 90 as string)) shape_id,
               o_orderkey % 2 direction_id, o_orderpriority trip_headsign,
               case when o_orderkey % 3 = 0 then 'NaN' when o_orderkey % 3 = 1 then 'UNKNOWN'
                    else o_orderstatus end calendar_desc
        from $orders""",
    # Hours run to 25 and minutes to 55, so some trips begin or end past midnight.
    "stop_times": f"""
        select trip_id, stop_id, stop_sequence, pickup_type, drop_off_type, timepoint,
               shape_dist_traveled, concat(hour_minute, ':00') arrival_time,
               concat(hour_minute, ':30') departure_time
        from (select cast(l_orderkey as string) trip_id, l_suppkey stop_id,
                     l_linenumber * 1000000000000 + l_partkey stop_sequence,
                     cast(l_linenumber % 2 as bigint) pickup_type,
                     cast(l_partkey % 2 as bigint) drop_off_type, cast(1 as bigint) timepoint,
                     (l_linenumber + l_partkey % 4) * 0.25E0 shape_dist_traveled,
                     concat({_two_digits("(l_orderkey + l_linenumber) % 26")}, ':',
                            {_two_digits("l_linenumber * 7 + l_partkey % 7")}) hour_minute
              from $lineitem) calls""",
    "routes": """
        select cast(c_custkey as string) route_id, c_name route_long_name,
               concat('R', cast(c_custkey % 100 as string)) route_short_name,
               cast(3 as bigint) route_type, lpad(cast(c_custkey as string), 6, '0') route_color,
               'FFFFFF' route_text_color, cast(c_nationkey as string) line_id,
               case when c_nationkey % 6 = 5 then null else n_name end line_long_name,
               concat('L', cast(c_nationkey as string)) line_short_name,
               cast(c_nationkey % 4 as double) line_type,
               concat(n_name, ' ', c_mktsegment) tts_name, 'A1' agency_id,
               cast(c_custkey % 2 as bigint) circular,
               case when c_custkey % 3 = 0 then 1E0 when c_custkey % 3 = 1 then 0E0 end school
        from $customer join $nation on c_nationkey = n_nationkey""",
    "weekdays": """
        select user_id, cast((extract(day from ts) - 1) % 7 as int) d from $events""",
    "calendar": """
        select distinct
               concat('S', cast(case when d < 5 then user_id % 3 else 3 + user_id % 2 end as string))
                   service_id,
               cast('2024-01-01' as date) + d service_date, cast(20240101 + d as bigint) date,
               cast(case when d < 5 then 1 when d = 5 then 2 else 3 end as bigint) day_type,
               cast(case when d = 2 and user_id % 3 = 1 then 2 else 1 end as bigint) exception_type,
               cast(case when d = 0 then 1 else 0 end as bigint) holiday,
               cast(case when d <= 3 then 1 when d <= 5 then 2 else 9 end as bigint) period
        from weekdays""",
    "dates": """
        select distinct date, service_date day_date, day_type, holiday, period,
               case when holiday = 1 then 'NaN day' else 'UNKNOWN' end notes
        from calendar""",
    "periods": """
        select distinct cast(case when d <= 3 then 1 else 2 end as bigint) period_id,
               case when d <= 3 then 'SUMMER' else 'SCHOOL' end period_name
        from weekdays""",
    "stops": """
        select s_suppkey stop_id, s_name stop_name, 38.5E0 + s_suppkey * 0.0078125E0 stop_latitude,
               -9.25E0 + s_suppkey * 0.0078125E0 stop_longitude,
               case when s_suppkey % 17 = 16 then 'UNKNOWN' else cast(s_nationkey as string) end
                   municipality_id,
               n_name municipality_name, cast(n_regionkey as string) region_id, r_name region_name,
               cast(case when s_suppkey % 4 = 0 then 1 when s_suppkey % 4 = 1 then 0 end as bigint)
                   near_school
        from $supplier join $nation on s_nationkey = n_nationkey
        join $region on n_regionkey = r_regionkey""",
    "municipalities": """
        select cast(c_nationkey as bigint) municipality_id, n_name municipality_name,
               cast(min(c_custkey) as bigint) municipality_prefix,
               cast(n_regionkey as bigint) district_id, concat('D_', r_name) district_name,
               cast(n_regionkey as string) region_id, r_name region_name
        from $customer join $nation on c_nationkey = n_nationkey
        join $region on n_regionkey = r_regionkey
        group by c_nationkey, n_name, n_regionkey, r_name""",
    "shapes": """
        select concat('SH', cast(l_orderkey % 90 as string)) shape_id,
               38.5E0 + (l_partkey % 64) * 0.015625E0 shape_pt_lat,
               -9.25E0 + (l_suppkey % 64) * 0.015625E0 shape_pt_lon,
               l_linenumber * 0.25E0 shape_dist_traveled,
               l_orderkey * 10 + l_linenumber shape_pt_sequence
        from $lineitem""",
    # -- stops as a view delivers them where one stop has several rows ------------------------
    "stop_rows": f"""
        select stop_id,
               case when copy = '20240102' and stop_id % 3 = 0 then concat(stop_name, ' new')
                    else stop_name end stop_name,
               stop_latitude, stop_longitude, municipality_id, municipality_name, region_id,
               region_name, near_school,
               case when copy = '20240102' and stop_id % 5 = 0
                    then cast('2023-12-31 00:00:00' as timestamp)
                    else cast('2024-01-02 00:00:00' as timestamp) end ingested_at
        from (select *, $unnest_two copy from stops) copies""",
    # -- feed tables as landed, over two extraction days, with copies and missing values -------
    "raw_trips": """
        select trip_id, route_id, service_id, pattern_id, shape_id, direction_id,
               case when direction_id = 1 then trip_headsign end trip_headsign,
               case when calendar_desc <> 'UNKNOWN' then calendar_desc end calendar_desc,
               'trips.txt' _source_file, partition_date
        from (select *, $unnest_two partition_date from (select *, $unnest_copies copy from trips) c
             ) copies""",
    "raw_stop_times": """
        select trip_id, stop_id, stop_sequence, pickup_type, drop_off_type, timepoint,
               case when pickup_type = 1 then shape_dist_traveled end shape_dist_traveled,
               arrival_time, departure_time, 'stop_times.txt' _source_file, partition_date
        from (select *, $unnest_two partition_date from stop_times) s""",
    "raw_periods": """
        select period_id, case when period_id = 1 then period_name end period_name,
               'periods.txt' _source_file, partition_date
        from (select *, $unnest_two partition_date from periods) p""",
    "raw_dates": """
        select date, day_type, holiday, period, case when holiday = 1 then notes end notes,
               'dates.txt' _source_file, partition_date
        from (select *, $unnest_two partition_date from dates) d""",
    "raw_calendar_dates": """
        select date, day_type, exception_type, holiday, period, service_id,
               'calendar_dates.txt' _source_file, partition_date
        from (select *, $unnest_two partition_date from calendar) c""",
    "raw_shapes": """
        select shape_dist_traveled, shape_id, shape_pt_lat, shape_pt_lon, shape_pt_sequence,
               'shapes.txt' _source_file, partition_date
        from (select *, $unnest_two partition_date from shapes) s""",
    "raw_municipalities": """
        select district_id, district_name, municipality_id, municipality_name,
               municipality_prefix, region_id, region_name,
               'municipalities.txt' _source_file, partition_date
        from (select *, $unnest_two partition_date from municipalities) m""",
    "raw_lines": f"""
        select {_filler("lines", "c_nationkey", {
            "id": "cast(c_nationkey as string)",
            "long_name": "n_name",
            "municipality_ids": ROUTE_ID_LIST,
            "route_ids": ROUTE_ID_LIST,
        })},
               '/lines' _endpoint, partition_date
        from (select *, $unnest_two partition_date from $customer) c
        join $nation on c_nationkey = n_nationkey""",
    "raw_endpoint_routes": f"""
        select {_filler("endpoint_routes", "c_custkey", {
            "id": "cast(c_custkey as string)",
            "line_id": "cast(c_nationkey as string)",
            "long_name": "c_name",
            "municipality_ids": ROUTE_ID_LIST,
            "stop_ids": ROUTE_ID_LIST,
        })},
               '/routes' _endpoint, partition_date
        from (select *, $unnest_two partition_date from $customer) c""",
    "raw_gtfs_routes": f"""
        select {_filler("gtfs_routes", "c_custkey", {
            "line_id": "cast(c_nationkey as bigint)",
            "route_id": "case when c_acctbal < 0 then concat('gone ', cast(c_custkey as string)) "
            "else cast(c_custkey as string) end",
            "route_long_name": "case when partition_date = '20240102' and c_custkey % 3 = 0 "
            "then concat(c_name, ' new') else c_name end",
        })},
               'routes.txt' _source_file, partition_date
        from (select *, $unnest_two partition_date from $customer) c""",
    "raw_endpoint_stops": f"""
        select {_filler("endpoint_stops", "s_suppkey", {
            "id": "case when s_suppkey % 11 = 5 then concat('x', cast(s_suppkey as string)) "
            "else lpad(cast(s_suppkey as string), 6, '0') end",
            "municipality_id": "cast(s_nationkey as string)",
            "wheelchair_boarding": "s_suppkey % 2 = 0",
            "facilities": STOP_ID_LIST,
            "line_ids": STOP_ID_LIST,
            "pattern_ids": STOP_ID_LIST,
            "route_ids": STOP_ID_LIST,
        })},
               '/stops' _endpoint, partition_date
        from (select *, $unnest_two partition_date from $supplier) s""",
    "raw_gtfs_stops": f"""
        select {_filler("gtfs_stops", "s_suppkey", {
            "stop_id": "case when s_suppkey % 13 = 6 then -1 - s_suppkey else s_suppkey end",
            "stop_name": "case when s_suppkey % 3 = 0 and partition_date = '20240102' "
            "then concat(s_name, ' new') else s_name end",
            "stop_lat": "38.5E0 + s_suppkey * 0.0078125E0",
            "stop_lon": "-9.25E0 + s_suppkey * 0.0078125E0",
            "municipality_id": "cast(s_nationkey as bigint)",
        })},
               'stops.txt' _source_file, partition_date
        from (select *, $unnest_two partition_date from $supplier) s""",
    # -- staged tables over several extraction days ------------------------------------------
    "staged_trips": f"""
        select trip_id, route_id, service_id, pattern_id, shape_id, direction_id,
               case when extracted = '20240101' then 'old' else trip_headsign end trip_headsign,
               calendar_desc, 'trips.txt' _source_file,
               cast('2024-01-03 04:00:00' as timestamp) ingested_at,
               {DAY.format("extracted")} partition_date
        from (select *, $unnest_three extracted from trips) t""",
    "staged_stop_times": f"""
        select trip_id, stop_id, stop_sequence, pickup_type, drop_off_type, timepoint,
               case when extracted = '20240101' then 0E0 else shape_dist_traveled end shape_dist_traveled,
               arrival_time, departure_time, 'stop_times.txt' _source_file,
               cast('2024-01-03 04:00:00' as timestamp) ingested_at,
               {DAY.format("extracted")} partition_date
        from (select *, $unnest_two extracted from stop_times) s""",
    "staged_periods": f"""
        select period_id, concat(period_name, ' ', extracted) period_name, 'periods.txt' _source_file,
               cast('2024-01-03 04:00:00' as timestamp) ingested_at,
               {DAY.format("extracted")} partition_date
        from (select *, $unnest_three extracted from periods) p""",
    "staged_dates": f"""
        select date, day_type, holiday, concat(notes, ' ', extracted) notes, period,
               'dates.txt' _source_file, cast('2024-01-03 04:00:00' as timestamp) ingested_at,
               {DAY.format("extracted")} partition_date
        from (select *, $unnest_two extracted from dates) d""",
    "staged_calendar_dates": f"""
        select date, day_type, case when extracted = '20240101' then 2 else exception_type end
                   exception_type,
               holiday, period, service_id, 'calendar_dates.txt' _source_file,
               cast('2024-01-03 04:00:00' as timestamp) ingested_at,
               {DAY.format("extracted")} partition_date
        from (select *, $unnest_two extracted from calendar) c""",
    "staged_shapes": f"""
        select shape_dist_traveled, shape_id, shape_pt_lat, shape_pt_lon,
               case when extracted = '20240101' then -1 else shape_pt_sequence end shape_pt_sequence,
               'shapes.txt' _source_file, cast('2024-01-03 04:00:00' as timestamp) ingested_at,
               {DAY.format("extracted")} partition_date
        from (select *, $unnest_two extracted from shapes) s""",
    "staged_municipalities": f"""
        select district_id, district_name, municipality_id, municipality_name,
               municipality_prefix, region_id, concat(region_name, ' ', extracted) region_name,
               'municipalities.txt' _source_file,
               cast('2024-01-03 04:00:00' as timestamp) ingested_at,
               {DAY.format("extracted")} partition_date
        from (select *, $unnest_two extracted from municipalities) m""",
    # -- single-purpose inputs ------------------------------------------------------------------
    "dirty": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber,
               case when l_linenumber = 1 then cast('NaN' as double)
                    when l_linenumber = 2 then null else l_quantity end dist,
               case when l_linenumber = 3 then null when l_linenumber = 4 then 'NaN'
                    when l_linenumber = 5 then 'xNaNx' when l_linenumber = 6 then 'UNKNOWN'
                    else l_returnflag end has_pole
        from $lineitem""",
    "flags": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber,
               cast(case when l_linenumber < 6 then l_linenumber end as bigint) day_type,
               cast(case when l_suppkey % 3 < 2 then l_suppkey % 3 end as bigint) holiday,
               cast(case when l_partkey % 3 < 2 then 1 + l_partkey % 3 end as bigint) exception_type,
               case when l_orderkey % 3 < 2 then cast(l_orderkey % 3 as double) end school,
               case when l_partkey % 5 = 0 then 25200 when l_partkey % 5 = 1 then 32400
                    when l_partkey % 5 = 2 then 72001 else (l_orderkey * 600 + l_linenumber) % 86400
               end clock
        from $lineitem""",
    "day_texts": """
        select event_id,
               case when user_id % 9 = 0 then 'UNKNOWN' when user_id % 9 = 1 then '20240231'
                    else concat('202401', lpad(cast(extract(day from ts) as string), 2, '0')) end
                   partition_date
        from $events""",
    "day_numbers": """
        select event_id, 20240100 + cast(extract(day from ts) as bigint) date from $events""",
    # -- dimensions on two days, for their history ----------------------------------------------
    "stops_before": """
        select stop_id, stop_name, stop_latitude, stop_longitude, municipality_id,
               municipality_name, region_id, region_name, near_school
        from stops join $supplier on stop_id = s_suppkey where s_acctbal < 9000""",
    "stops_after": """
        select stop_id, stop_name,
               case when stop_id % 9 = 0 then null else stop_latitude end stop_latitude,
               stop_longitude,
               case when stop_id % 7 = 0 then 'moved' else municipality_id end municipality_id,
               municipality_name, region_id, region_name,
               case when stop_id % 8 = 2 then 1 else near_school end near_school
        from stops join $supplier on stop_id = s_suppkey where s_acctbal > 500""",
    "lines_before": """
        select routes.* from routes join $customer on route_id = cast(c_custkey as string)
        where c_acctbal < 9000""",
    "lines_after": """
        select route_id, case when c_custkey % 7 = 0 then 'renamed' else route_long_name end
                   route_long_name,
               route_short_name, route_type, route_color, route_text_color, line_id,
               line_long_name, line_short_name, line_type, agency_id, tts_name, circular,
               case when c_custkey % 6 = 2 then 1E0 else school end school
        from routes join $customer on route_id = cast(c_custkey as string)
        where c_acctbal > 500""",
    "trips_before": """
        select trip_id, direction_id direction, trips.route_id, service_id, trip_headsign,
               pattern_id, shape_id
        from trips join $orders on trip_id = cast(o_orderkey as string)
        where o_totalprice < 450000""",
    "trips_after": """
        select trip_id, direction_id direction, route_id,
               case when o_orderkey % 10 = 3 then 'S9' else service_id end service_id,
               case when o_orderkey % 10 = 4 then null else trip_headsign end trip_headsign,
               pattern_id, shape_id
        from trips join $orders on trip_id = cast(o_orderkey as string)
        where o_totalprice > 20000""",
}

_NAMES = re.compile(r"\b(" + "|".join(INPUTS) + r")\b")


def input_ctes(query: str, dialect: str, tables: dict[str, str]) -> str:
    """`query` with a WITH clause for the inputs it names, directly or through others."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in set(_NAMES.findall(sql)) - needed:
            needed.add(name)
            visit(INPUTS[name])

    visit(query)
    unnest = UNNEST[dialect]
    words = {
        **tables,
        "unnest_two": unnest.format(TWO_DAYS),
        "unnest_three": unnest.format(THREE_DAYS),
        "unnest_copies": unnest.format("1, 2"),
    }
    ctes = [f"{name} as ({INPUTS[name]})" for name in INPUTS if name in needed]
    if ctes:
        own, rest = re.match(r"\s*(with\s)?(.*)", query, re.DOTALL).groups()
        query = f"with {', '.join(ctes)}{', ' if own else ' '}{rest}"
    return Template(query).substitute(words)


# Layouts of tables already opened: each is read from its files once per process.
_LAYOUTS: dict[str, StructType] = {}


def _bytes(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


class Inputs:
    """The derived inputs over the parquet files of one folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _LAYOUTS:
            _LAYOUTS[path] = self.spark.read.parquet(path).schema
        rows = self.spark.read.schema(_LAYOUTS[path]).parquet(path)
        if name in WIDENED:
            pieces = _bytes(self.spark, path) // WIDENED_BYTES
            rows = rows.repartition(pieces) if pieces > 1 else rows
        return rows

    def __call__(self, name: str) -> DataFrame:
        return self.query(f"select * from {name}")

    def query(self, sql: str) -> DataFrame:
        text = input_ctes(sql, "spark", {t: f"{{{t}}}" for t in BASE_TABLES})
        used = {t: self.table(t) for t in BASE_TABLES if f"{{{t}}}" in text}
        return self.spark.sql(text, **used)


def duckdb_sql(query: str) -> str:
    """`query` over the inputs, for DuckDB, where the base tables are views."""
    return input_ctes(query, "duckdb", {t: t for t in BASE_TABLES})
