"""The same questions in plain SQL for DuckDB.

Each statement starts from the question: what a trip's times come to is read off lists of them, the
days of a service are one list beside each trip, a stop event is described from four sides, and what a
side lacks is looked up. The analyses run over the full facts, and copies are removed last. Column
lists that the library is checked for are stated here again.
"""

from __future__ import annotations

from headway.catalogue.inputs import duckdb_sql
from headway.catalogue.queries import AS_OF, LINE_ID, QUOTED_TRIPS, RUN_AT, SNAPSHOT_TIMES
from headway.catalogue.stated import (
    ARRAYS,
    MERGED,
    CHECKED,
    ROUTE_COLUMNS,
    STOP_COLUMNS,
    STOP_SENTINEL_COLUMNS,
    TRACKED,
    UNREPEATED,
)
from headway.schemas import feed_schema, lineage_column

STAMP = f"'{RUN_AT}' ingested_at"
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def _key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as string), '{NULL_TOKEN}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def _seconds(column: str) -> str:
    hour, minute, second = (
        f"try_cast(split_part({column}, ':', {i}) as bigint)" for i in (1, 2, 3)
    )
    return f"({hour} * 3600 + {minute} * 60 + {second})"


def _day(text: str) -> str:
    return f"cast(try_strptime({text}, '%Y%m%d') as date)"


def _filled(name: str, kind: str) -> str:
    if kind == "string":
        return f"coalesce({name}, 'UNKNOWN') {name}"
    if kind == "double":
        return f"case when {name} is null or isnan({name}) then 0E0 else {name} end {name}"
    return name


def _staged(table: str) -> str:
    """Raw rows of a feed table stamped, dated, filled, without copies."""
    columns = [_filled(f.name, f.dataType.simpleString()) for f in feed_schema(table)]
    lineage = lineage_column(table)
    return (
        f"select distinct {', '.join(columns)}, coalesce({lineage}, 'UNKNOWN') {lineage}, {STAMP}, "
        f"cast({_day('partition_date')} as string) partition_date from raw_{table}"
    )


def _content(table: str) -> str:
    """The sum of 60 bits of each row's MD5, of the values as text; millionths of numbers with a fraction."""
    values = [
        f"floor({f.name} * 1000000)::bigint" if f.dataType.simpleString() == "double" else f.name
        for f in feed_schema(table)
    ]
    parts = ", ".join(f"coalesce(cast({v} as varchar), chr(30))" for v in [*values, lineage_column(table)])
    return f"cast(sum(cast('0x' || substr(md5(concat_ws(chr(31), {parts})), 1, 15) as bigint)) as varchar)"


def _merged(entity: str, match_partition: bool = True) -> str:
    feed_key, left_out, renamed = MERGED[entity]
    ours = feed_schema(f"endpoint_{entity}").fieldNames()
    theirs = feed_schema(f"gtfs_{entity}").fieldNames()
    kept = [f"e.{c}" for c in ours if c not in left_out]
    kept += [
        f"g.{c} {renamed.get(c, c)}" for c in theirs if c not in ours and c not in left_out
    ]
    key = "try_cast(e.id as bigint)" if entity == "stops" else "e.id"
    same_day = "and e.partition_date = g.partition_date" if match_partition else ""
    return f"""
        select distinct {', '.join(kept)}, e._endpoint, g._source_file, e.ingested_at,
               e.partition_date
        from ({_staged(f"endpoint_{entity}")}) e join ({_staged(f"gtfs_{entity}")}) g
          on {key} = g.{feed_key} {same_day}"""


def _array(column: str) -> str:
    parsed = f"cast(to_json(from_json({column}, '[\"VARCHAR\"]')) as string)"
    return f"case when json_valid({column}) then {parsed} end"


def _view(entity: str, columns: list[str]) -> str:
    shown = []
    for c in columns:
        if c in ARRAYS[entity]:
            shown.append(f"{_array(c)} {c}")
        elif entity == "stops" and c in STOP_SENTINEL_COLUMNS:
            shown.append(f"replace(replace({c}, 'NaN', 'N/A'), 'UNKNOWN', 'N/A') {c}")
        else:
            shown.append(c)
    return f"""
        with merged as ({_merged(entity)})
        select {', '.join(shown)} from merged
        where partition_date = (select max(partition_date) from merged)"""


def _latest(table: str, columns: str = "*", anchor: str | None = None, replace: str = "") -> str:
    replaced = ", ".join(
        [
            "cast(partition_date as string) as partition_date",
            "cast(ingested_at as string) as ingested_at",
            *([replace] if replace else []),
        ]
    )
    return f"""
        select {columns} replace ({replaced}) from {table}
        where partition_date = (select max(partition_date) from {anchor or table})"""


# What a trip's stop times come to, by lists of its times: the question is about one trip at a time.
TRIP_TIMES = f"""
    select trip_id, list(leaves) leaves, list(arrives) arrives, max(shape_dist_traveled) far,
           count(*) total_stops
    from (select trip_id, shape_dist_traveled, {_seconds("departure_time")} leaves,
                 {_seconds("arrival_time")} arrives from stop_times)
    group by trip_id"""

TRIP_SUMMARY = f"""
    select trip_id, list_min([x % 86400 for x in leaves]) departure_time_begin,
           list_max([x % 86400 for x in arrives]) arrival_time_end,
           round((list_max(arrives) - list_min(leaves)) / 60) duration_minutes,
           round(far, 2) distance_km, total_stops
    from ({TRIP_TIMES})"""

PEAK = """(day_type = 1 and exception_type = 1 and holiday = 0
    and ({0} between 25200 and 32400 or {0} between 61200 and 72000))"""

# The days of a service as one list, taken apart again beside each of its trips.
SERVICE_DAYS = """
    select service_id, list({'service_date': service_date, 'date': date, 'day_type': day_type,
                             'exception_type': exception_type, 'holiday': holiday}) runs
    from {0} group by service_id"""

TRIP_PEAK = f"""
    select distinct trip_id, service_date, first_departure, day_type, exception_type, holiday,
           coalesce({PEAK.format("first_departure")}, false) is_peak
    from (select trip_id, first_departure, unnest(runs, recursive := true)
          from (select trip_id, departure_time_begin first_departure,
                       (select service_id from trips where trips.trip_id = s.trip_id) service_id
                from ({TRIP_SUMMARY}) s)
          natural join ({SERVICE_DAYS.replace("{0}", "calendar")}))"""


def _schedule(calendar: str = "calendar") -> str:
    """Each trip with its own summary, if it has stop times, once for every day in its service's list."""
    told = "departure_time_begin arrival_time_end duration_minutes distance_km total_stops".split()
    looked_up = ", ".join(
        f"(select {c} from summary where summary.trip_id = trips.trip_id) {c}" for c in told
    )
    return f"""
    select {_key("trip_id", "service_date")} trip_key, trip_id, cast(service_date as string) trip_date,
           route_id, pattern_id, shape_id, service_id, direction_id, trip_headsign,
           departure_time_begin departure_time, arrival_time_end arrival_time, duration_minutes,
           coalesce({PEAK.format("departure_time_begin")}, false) is_peak,
           coalesce(distance_km, 0) distance_km, total_stops, {STAMP}
    from (with summary as materialized ({TRIP_SUMMARY})
          select * exclude (runs), unnest(runs, recursive := true)
          from (select trips.*, {looked_up} from trips)
          natural join ({SERVICE_DAYS.replace("{0}", calendar)}))"""


SCHEDULE = f"with fact_trip_schedule as ({_schedule()})"

# A stop event is a call seen from four sides, each described on its own: its trip, its stop, its day,
# and the call itself.
TRIP_SIDE = """
    select trip_id, service_id, route_id, unnest(line) from (
      select trip_id, service_id, route_id,
             (select {'line_id': line_id, 'line_long_name': line_long_name,
                      'line_short_name': line_short_name, 'route_long_name': route_long_name,
                      'route_short_name': route_short_name,
                      'serves_school_route': coalesce(school = 1, false)}
              from routes where routes.route_id = trips.route_id) line
      from trips) named
    where line is not null"""
STOP_SIDE = """
    select stop_id, stop_name, municipality_id, municipality_name, region_id, region_name,
           district.district_id, district.district_name,
           coalesce(near_school = 1, false) is_near_school
    from (select *, (select {'district_id': district_id, 'district_name': district_name}
                     from municipalities
                     where municipalities.municipality_id = try_cast(stops.municipality_id as bigint))
                    district
          from stops)
    where district is not null"""
DAY_SIDE = """
    select service_id, cast(service_date as string) stop_event_date, coalesce(holiday = 1, false) is_holiday,
           coalesce(day_type = 2 or day_type = 3, false) is_weekend
    from calendar"""

STOP_EVENT = f"""
    select {_key("stop_id", "trip_id", "stop_event_date", "stop_sequence")} stop_event_key,
           * exclude (service_id), 1 stop_event_count, {STAMP}
    from (select trip_id, stop_id, stop_sequence, pickup_type, drop_off_type from stop_times)
    natural join ({TRIP_SIDE}) natural join ({STOP_SIDE}) natural join ({DAY_SIDE})"""

EVENTS = f"with fact_stop_event as ({STOP_EVENT})"


def _version(key: str, at: str) -> str:
    return f"md5(concat_ws('|', cast({key} as string), '{at}.000000'))"


def _history(dimension: str, before: str, after: str) -> str:
    """WITH clause whose last relation, h2, is the history after three snapshots."""
    k, checked = TRACKED[dimension]
    kept = ", ".join([k, *checked, "ingested_at"])
    books = "dbt_scd_id, dbt_valid_from, dbt_valid_to"
    states = [
        f"c{i} as (select {k}, {', '.join(checked)}, '{at}' ingested_at from {source})"
        for i, (source, at) in enumerate(zip((before, after, before), SNAPSHOT_TIMES))
    ]
    t0 = SNAPSHOT_TIMES[0]
    steps = [
        f"h0 as (select {kept}, {_version(k, t0)} dbt_scd_id, '{t0}' dbt_valid_from, "
        "cast(null as string) dbt_valid_to from c0)"
    ]
    for i in (1, 2):
        at, h, c = SNAPSHOT_TIMES[i], f"h{i - 1}", f"c{i}"
        differs = " or ".join(f"o.{x} is distinct from n.{x}" for x in checked)
        steps.append(f"""
            changed{i} as (select o.{k} from {h} o join {c} n on o.{k} = n.{k}
                           where o.dbt_valid_to is null and ({differs}))""")
        steps.append(f"""
            h{i} as (
              select {kept}, dbt_scd_id, dbt_valid_from,
                     case when dbt_valid_to is null and {k} in (select {k} from changed{i})
                          then '{at}' else dbt_valid_to end dbt_valid_to
              from {h}
              union all
              select {kept}, {_version(k, at)}, '{at}', null from {c}
              where {k} in (select {k} from changed{i})
                 or {k} not in (select {k} from {h} where dbt_valid_to is null))""")
    return f"with {', '.join(states + steps)} select {kept}, {books} from h2"


def _report(relation: str, column: str) -> str:
    return (
        f"select '{column}' column_name, 'not_null' check_name, "
        f"count(*) - count({column}) failures from {relation}"
    )


SCHEDULE_COLUMNS = """
    trip_key trip_id trip_date route_id pattern_id shape_id service_id direction_id
    trip_headsign departure_time arrival_time duration_minutes is_peak distance_km
    total_stops ingested_at
""".split()
STAGED_TABLES = """
    lines endpoint_routes gtfs_routes endpoint_stops gtfs_stops stop_times trips periods
    dates calendar_dates shapes municipalities
""".split()

SQL = {
    # -- sources and sinks
    "read_json_payload": """
        select '/records' _endpoint, cast(c_custkey as string) id, c_name "name",
               cast(to_json([c_mktsegment, c_name]) as string) detail from $customer
        union all
        select '/data', cast(c_custkey as string), c_name,
               cast(to_json([c_mktsegment, c_name]) as string) from $customer
        union all
        select '/object', cast(c_custkey as string), c_name,
               concat(cast(c_nationkey as string), '|', cast(to_json([c_mktsegment]) as string))
        from $customer""",
    "nested_endpoint": """
        select 'facilities_schools' entity, cast(c_custkey as string) id, c_name "name",
               '/facilities/schools' _endpoint from $customer
        union all
        select 'facilities_helpdesks_all', cast(s_suppkey as string), s_name, '/facilities/helpdesks/all/'
        from $supplier""",
    "nested_to_json": """
        select c_custkey, cast(to_json({'name': c_name, 'nation': c_nationkey}) as string) place,
               cast(to_json([c_mktsegment, concat('é', c_name)]) as string) tags,
               cast(to_json(map {'segment': c_mktsegment}) as string) extra from $customer""",
    "read_gtfs_text": """
        select arrival_time, departure_time, drop_off_type, pickup_type, shape_dist_traveled,
               stop_id, stop_sequence, cast(null as bigint) timepoint, trip_id from stop_times""",
    "dynamic_overwrite": """
        with raw as (select distinct * exclude (partition_date) from raw_trips)
        select *, '20240101' partition_date from raw
        union all
        select * replace ('again' as trip_headsign), '20240102' from raw""",
    "schema_on_read": "select * replace (cast(null as bigint) as timepoint) from raw_stop_times",
    "stage_table": _staged("trips"),
    "stage_all": " union all ".join(
        f"select '{t}' table_name, partition_date, count(*) row_count, {_content(t)} content "
        f"from ({_staged(t)}) group by partition_date"
        for t in STAGED_TABLES
    ),
    # What the second day's files say; the first day only tells which stops had another name.
    "catalog_sql": f"""
        with called as (
            select trip_id, stop_id, {_seconds("departure_time")} % 86400 leaves
            from ({_staged("stop_times")}) where partition_date = '2024-01-02'
        ), departed as (
            select trip_id, min(leaves) departure from called group by trip_id
        ), named as ({_merged("stops")}), known as ({_merged("routes")}), ridden as ({_staged("trips")}),
        ran as (
            select trip_id, service_id, line_id from ridden natural join (select route_id, line_id, partition_date from known)
            where partition_date = '2024-01-02'
        ), lying as (
            select n.stop_id, n.region_name, exists (
                       select 1 from named o where o.stop_id = n.stop_id and o.partition_date = '2024-01-01'
                       and o.stop_name <> n.stop_name) renamed
            from named n where n.partition_date = '2024-01-02'
              and try_cast(n.municipality_id as bigint) in (select municipality_id from ({_staged("municipalities")}))
        ), on_days as (
            select service_id, cast({_day("cast(date as string)")} as string) stop_event_date, day_type, exception_type,
                   holiday
            from ({_staged("calendar_dates")}) where partition_date = '2024-01-02'
        )
        select region_name, stop_event_date, count(*) stop_events,
               count(*) filter (where {PEAK.format("departure")}) peak_events,
               count(distinct trip_id) trips, count(distinct stop_id) stops, count(distinct line_id) lines,
               count(distinct case when renamed then stop_id end) renamed_stops,
               (select count(*) from ridden) staged_trips
        from called natural join departed natural join ran natural join lying natural join on_days
        group by region_name, stop_event_date""",
    "fact_partitioned_sink": _schedule(),
    "read_gtfs_text_quoted": f"""
        select trip_id, headsign trip_headsign, route_id, cast(null as bigint) direction_id,
               'part' _source_file from ({QUOTED_TRIPS})""",
    "stage_table_day": f"""
        select * from ({_staged("trips")})
        where case partition_date when '2024-01-01' then direction_id = 0
                                  when '2024-01-02' then false else true end""",
    "merge_staged": _merged("routes"),
    "convert_staged": f"""
        select * replace ({", ".join(f"{_array(c)} as {c}" for c in ARRAYS["lines"])})
        from ({_staged("lines")})""",
    # -- cleaning
    "parse_partition_date": f"""
        select event_id, cast({_day("partition_date")} as string) partition_date from day_texts""",
    "clean_fill": f"""
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, {_filled("dist", "double")},
               {_filled("has_pole", "string")} from dirty""",
    "json_to_array": f"""
        select id, partition_date,
               {", ".join(f"{_array(c)} {c}" for c in ARRAYS["stops"])}
        from raw_endpoint_stops""",
    "dedup_full_row": f"""
        select distinct l_suppkey, l_linenumber, {_filled("dist", "double")},
               {_filled("has_pole", "string")} from dirty""",
    "sentinel_normalise": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber,
               replace(replace(has_pole, 'NaN', 'N/A'), 'UNKNOWN', 'N/A') anywhere,
               case when has_pole in ('NaN', 'UNKNOWN') then 'N/A' else has_pole end exact
        from dirty""",
    "stage_rows": _staged("gtfs_stops"),
    # -- merge and latest day
    "merge_routes": _merged("routes"),
    "merge_stops": _merged("stops"),
    "merge_stops_all_days": _merged("stops", match_partition=False),
    "latest_partition": _latest("staged_shapes"),
    "latest_partition_on_disk": _latest("staged_shapes"),
    "latest_partition_anchored": _latest("staged_trips", anchor="staged_stop_times"),
    # -- functions
    "gtfs_clock_time": f"""
        select trip_id, stop_id, stop_sequence, {_seconds("departure_time")} % 86400 clock,
               concat(lpad(cast(cast(split_part(departure_time, ':', 1) as bigint) % 24 as string),
                           2, '0'),
                      substr(departure_time, strpos(departure_time, ':'))) clock_text
        from stop_times""",
    "gtfs_seconds": f"""
        select trip_id, stop_id, stop_sequence, {_seconds("departure_time")} departure_seconds,
               cast(null as bigint) no_time from stop_times""",
    "parse_gtfs_date": """
        select event_id, cast(make_date(date // 10000, date // 100 % 100, date % 100) as string)
               service_date from day_numbers""",
    "peak_flag": f"""
        select l_orderkey, l_partkey, l_suppkey, l_linenumber,
               coalesce(day_type = 1, false) and at_peak by_day,
               coalesce(day_type = 1 and exception_type = 1, false) and at_peak by_exception,
               coalesce(day_type = 1 and holiday = 0, false) and at_peak by_holiday,
               coalesce({PEAK.format("clock")}, false) by_all
        from (select *, clock between 25200 and 32400 or clock between 61200 and 72000 at_peak
              from flags) f""",
    "stop_event_flags": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber,
               case when holiday = 1 then true else false end is_holiday,
               case when day_type in (2, 3) then true else false end is_weekend,
               case when school = 1 then true else false end serves_school_route
        from flags""",
    "trip_duration": f"""
        select trip_id, stop_id, stop_sequence,
               round(({_seconds("departure_time")} - {_seconds("arrival_time")}) / 60) forward,
               round(({_seconds("arrival_time")} - {_seconds("departure_time")}) / 60) backward
        from stop_times""",
    "surrogate_key": f"""
        select distinct trip_id, partition_date, {_key("trip_id")} one,
               {_key("trip_headsign", "trip_id")} two,
               {_key("trip_id", _day("partition_date"), "calendar_desc")} three
        from raw_trips""",
    # -- staging views
    "stg_calendar_service": _latest(
        "staged_calendar_dates",
        f"cast({_day('cast(date as string)')} as string) service_date, *",
    ),
    "stg_dates": _latest(
        "staged_dates",
        f"cast({_day('cast(date as string)')} as string) day_date, *",
        replace="replace(notes, 'NaN', 'N/A') as notes",
    ),
    "stg_municipalities": _latest("staged_municipalities"),
    "stg_periods": _latest("staged_periods"),
    "stg_periods_anchored": _latest("staged_periods", anchor="staged_municipalities"),
    "stg_routes": _view("routes", ROUTE_COLUMNS),
    "stg_shapes": _latest("staged_shapes"),
    "stg_stop_times": _latest("staged_stop_times"),
    "stg_stops": _view("stops", STOP_COLUMNS),
    "stg_trips": _latest(
        "staged_trips", replace="replace(calendar_desc, 'NaN', 'N/A') as calendar_desc"
    ),
    "stg_trips_anchored": _latest(
        "staged_trips",
        anchor="staged_stop_times",
        replace="replace(calendar_desc, 'NaN', 'N/A') as calendar_desc",
    ),
    # -- dimensions and facts
    "dim_calendar_service": f"""
        select {_key("date", "service_id", "period_id")} calendar_service_key,
               cast(service_date as string) service_date, date, service_id, period_id, period_name,
               {STAMP}
        from (select date, period period_id, unnest(runs, recursive := true)
              from dates natural join (
                select date, list({{'service_id': service_id, 'service_date': service_date}}) runs
                from calendar group by date))
        natural join (select period_id, period_name from periods)""",
    "dim_line": f"""
        select {_key("route_id")} route_key, route_id, route_long_name, route_short_name, route_type,
               route_color, route_text_color, line_id, line_long_name, line_short_name, line_type,
               agency_id, tts_name, circular, school, {STAMP} from routes""",
    "dim_stop": f"""
        select {_key("stop_id")} stop_key, stop_id, stop_name, stop_latitude, stop_longitude,
               municipality_id, municipality_name, region_id, region_name, near_school, {STAMP}
        from (select *, row_number() over (partition by stop_id order by ingested_at, stop_name,
                stop_latitude, stop_longitude, municipality_id, municipality_name, region_id,
                region_name, near_school nulls first) row_num
              from stop_rows) s
        where row_num = 1""",
    "dim_trip": f"""
        select {_key("trip_id")} trip_key, trip_id, direction_id direction, route_id, service_id,
               trip_headsign, pattern_id, shape_id, {STAMP} from trips""",
    "trip_summary": TRIP_SUMMARY,
    "trip_summary_in_sequence": f"""
        select trip_id, min({_seconds("departure_time")}) % 86400 departure_time_begin,
               max({_seconds("arrival_time")}) % 86400 arrival_time_end,
               round((max({_seconds("arrival_time")}) - min({_seconds("departure_time")})) / 60)
                   duration_minutes,
               round(max(shape_dist_traveled), 2) distance_km, count(*) total_stops
        from stop_times group by trip_id""",
    "trips_with_routes": """
        select * from (select trip_id, route_id, service_id from trips)
        natural join (select route_id, route_long_name, route_short_name, line_id, line_long_name,
                             line_short_name, school from routes)""",
    "trips_with_dates": f"""
        select * replace (cast(service_date as string) as service_date)
        from (select * exclude (runs), unnest(runs, recursive := true)
              from trips natural join ({SERVICE_DAYS.replace("{0}", "calendar")}))""",
    "stops_enriched": f"""
        select * exclude (is_near_school),
               (select near_school from stops where stops.stop_id = side.stop_id) near_school
        from ({STOP_SIDE}) side""",
    "trip_peak_analysis": f"""
        select * replace (cast(service_date as string) as service_date) from ({TRIP_PEAK}) p""",
    "fact_trip_schedule": _schedule(),
    "fact_trip_schedule_active_days": _schedule(
        "(select * from calendar where exception_type = 1)"
    ),
    "fact_stop_event": STOP_EVENT,
    # -- history
    "snapshot_dim_line": _history("dim_line", "lines_before", "lines_after"),
    "snapshot_dim_stop": _history("dim_stop", "stops_before", "stops_after"),
    "snapshot_dim_trip": _history("dim_trip", "trips_before", "trips_after"),
    "snapshot_as_of": f"""
        select stop_id, stop_name, municipality_id, dbt_valid_from, dbt_valid_to
        from ({_history("dim_stop", "stops_before", "stops_after")}) h
        where dbt_valid_from <= '{AS_OF}' and (dbt_valid_to is null or '{AS_OF}' < dbt_valid_to)""",
    # -- data quality
    "dq_not_null": SCHEDULE
    + " union all ".join(_report("fact_trip_schedule", c) for c in SCHEDULE_COLUMNS),
    "dq_unique": EVENTS
    + " union all ".join(
        f"select '{c}' column_name, 'unique' check_name, count(*) failures from "
        f"(select {c} from fact_stop_event group by {c} having count(*) > 1)"
        for c in ("stop_event_key", "stop_id")
    ),
    "dq_contract": """
        select 'broken stg_municipalities' model, * from (values
            ('district_id', 'bigint', 'string'), ('region_name', 'string', 'missing'),
            ('surplus', 'missing', 'int')) faults(column_name, promised, found)""",
    # -- analyses
    "avgtime_trip": f"""{SCHEDULE}
        select round(avg(duration_minutes), 2) avg_trip_duration_minutes,
               round(min(duration_minutes), 2) min_duration_minutes,
               round(max(duration_minutes), 2) max_duration_minutes,
               round(stddev_samp(duration_minutes), 2) stddev_duration_minutes,
               count(*) total_trips_analyzed
        from fact_trip_schedule where duration_minutes > 0""",
    "daily_line_frequency": f"""{EVENTS}
        select stop_name, line_short_name, line_long_name,
               round(calls / len(per_day), 0) avg_daily_frequency,
               cast(list_min(per_day) as bigint) min_daily_frequency,
               cast(list_max(per_day) as bigint) max_daily_frequency, calls total_frequency,
               cast(len(per_day) as bigint) days_operated
        from (select stop_id, stop_name, line_id, line_short_name, line_long_name, count(*) calls,
                     map_values(histogram(stop_event_date)) per_day
              from fact_stop_event group by all)""",
    "distance_trip": f"""{SCHEDULE}
        select trip_id, trip_date, route_id, distance_km total_distance_km, duration_minutes
        from fact_trip_schedule where distance_km > 0""",
    "line_frequency": f"""{EVENTS}
        select stop_id, stop_name, municipality_name, count(*) total_frequency,
               count(distinct stop_event_date) days_served,
               count(*) / count(distinct stop_event_date) avg_frequency_per_day,
               count(distinct trip_id) unique_trips, min(stop_event_date) first_service_date,
               max(stop_event_date) last_service_date
        from fact_stop_event where line_id = '{LINE_ID}'
        group by stop_id, stop_name, municipality_name""",
    "peak_schedule": f"""{SCHEDULE}
        select is_peak, count(*) trip_count,
               round(cast(count(*) * 100.0 as double) / sum(count(*)) over (), 2)
                   percentage_of_total
        from fact_trip_schedule group by is_peak""",
    "stops_by_municipality": f"""{EVENTS},
        served as (select distinct stop_id, municipality_id, municipality_name, district_name,
                          region_name from fact_stop_event)
        select municipality_name, district_name, region_name, count(*) total_stops,
               round(cast(100.0 * count(*) as double) / (select count(*) from served), 2)
                   percentage_of_total
        from served group by municipality_id, municipality_name, district_name, region_name""",
    "stops_by_region": f"""{EVENTS},
        served as (select distinct stop_id, region_id, region_name from fact_stop_event)
        select region_name, count(*) total_stops,
               round(cast(100.0 * count(*) as double) / (select count(*) from served), 2)
                   percentage_of_total
        from served group by region_id, region_name""",
    "stops_near_school": f"""{EVENTS}
        select stop_id, stop_name, municipality_name, district_name, region_name, is_near_school,
               count(distinct line_id) total_lines_serving,
               string_agg(distinct line_short_name, ', ' order by line_short_name) lines_serving,
               count(*) total_scheduled_arrivals, count(distinct stop_event_date) days_with_service
        from fact_stop_event where is_near_school
        group by stop_id, stop_name, municipality_name, district_name, region_name,
                 is_near_school""",
    "top10_lines_for_stop": f"""{EVENTS}
        select stop_id, stop_name, municipality_name, count(distinct line_id) total_lines,
               string_agg(distinct line_short_name, ', ' order by line_short_name) lines
        from fact_stop_event group by stop_id, stop_name, municipality_name
        order by total_lines desc, stop_id limit 10""",
    "trips_by_date": f"""{SCHEDULE}
        select trip_date, count(*) total_trips_scheduled from fact_trip_schedule group by trip_date""",
    "which_lines_for_each_stop": f"""{EVENTS}
        select stop_id, stop_name, municipality_name,
               string_agg(distinct line_short_name, ', ' order by line_short_name)
                   lines_serving_stop,
               count(distinct line_id) total_lines,
               string_agg(distinct line_short_name || ' (' || line_long_name || ')', '; '
                          order by line_short_name || ' (' || line_long_name || ')')
                   lines_with_details
        from fact_stop_event group by stop_id, stop_name, municipality_name""",
}


def _checks() -> str:
    """Every declared check: missing values of all stated columns, then values that repeat."""
    models = [f"{m} as materialized ({SQL[m]})" for m in CHECKED]
    missing = []
    for model, columns in CHECKED.items():
        shown = f"columns([{', '.join(map(repr, columns))}])" if columns else "columns(*)"
        missing.append(f"""
            select '{model}' model, column_name, 'not_null' check_name, failures
            from (unpivot (select count({shown}) from {model})
                  on columns(*) into name column_name value present),
                 lateral (select count(*) - present failures from {model})""")
    repeated = [
        f"select '{m}', '{c}', 'unique', count(*) from (select {c} from {m} where {c} is not null "
        f"group by {c} having count(*) > 1)"
        for m, columns in UNREPEATED.items()
        for c in columns
    ]
    return f"with {', '.join(models)} {' union all '.join(missing + repeated)}"


SQL["dq_all"] = _checks()


def oracle_sql() -> dict[str, str]:
    """Query name to the SQL DuckDB runs on the same tables."""
    return {name: duckdb_sql(sql) for name, sql in SQL.items()}
