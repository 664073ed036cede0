"""The queries: each operator of the library over the derived inputs, whole tables every time."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StructType, TimestampType

from headway.catalogue.inputs import Inputs
from headway.functions.gtfs import (
    clock_text,
    gtfs_clock_time,
    gtfs_seconds,
    is_one,
    is_weekend,
    parse_gtfs_date,
    peak_flag,
    trip_duration_minutes,
)
from headway.functions.keys import surrogate_key
from headway.operators.cleaning import (
    fill_missing,
    json_to_array,
    nested_to_json,
    normalise_sentinels,
)
from headway.operators.digests import portable_digest
from headway.operators.history import SNAPSHOTS, VALID_FROM, VALID_TO
from headway.operators.latest import latest_partition, newest_day
from headway.operators.merge import MERGES, merge_sources
from headway.operators.quality import contract_violations, not_null_report, unique_report
from headway.plans import analyses, daily, dimensions, facts, rollups, staging_views
from headway.plans.contracts import contract, not_null_columns
from headway.plans.snapshots import read_as_of, read_snapshot, take_snapshot
from headway.schemas import INGESTED_AT, PARTITION_COLUMN, feed_schema, lineage_column, raw_schema
from headway.session import scratch_dir
from headway.sources.fact_tables import write_fact
from headway.sources.landing import (
    land,
    land_endpoint,
    landed_endpoints,
    read_gtfs_text,
    read_json_payload,
)
from headway.sources.staging import (
    ARRAY_COLUMNS,
    StagedTable,
    convert_staged,
    merge_staged,
    parse_partition_date,
    stage,
    stage_all,
    stage_table,
    staged_tables,
)
from headway.sources.tables import (
    entity_name,
    in_parallel,
    raw_path,
    read_with_schema,
    replace_partitions,
    replace_table,
)
from headway.sources.versions import read_days

Query = Callable[[SparkSession, str], DataFrame]

RUN_AT = "2024-01-03 04:00:00"
SNAPSHOT_TIMES = ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
AS_OF = "2024-01-02 12:00:00"
LINE_ID = "11"
DAYS = tuple(dt.date(2024, 1, d) for d in (1, 2, 3))
# Trips with head signs that need quoting in CSV, in SQL that Spark and DuckDB both read.
QUOTED_TRIPS = """
    select cast(o_orderkey as string) trip_id, cast(o_custkey as string) route_id,
           case o_orderkey % 4 when 0 then 'plain' when 1 then 'Rua "A", Lisboa'
                when 2 then concat('two', chr(10), '"lines"') else 'x, y' end headsign
    from $orders"""

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Inputs], DataFrame]], Callable[[Inputs], DataFrame]]:
    """Register a function of the inputs as the query `name`."""
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: _printable(fn(Inputs(spark, sf_dir)))
        return fn

    return register


def _printable(df: DataFrame) -> DataFrame:
    """Dates, times and arrays as text, so that any client prints and compares them alike."""
    def text(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, ArrayType):
            return F.to_json(c).alias(field.name)
        if isinstance(field.dataType, (DateType, TimestampType)):
            return c.cast("string").alias(field.name)
        return c

    return df.select([text(f) for f in df.schema])


def _run_at():
    return F.to_timestamp(F.lit(RUN_AT))


def _fact_inputs(src: Inputs) -> tuple[DataFrame, ...]:
    names = ("stop_times", "trips", "routes", "calendar", "stops", "municipalities")
    return tuple(map(src, names))


def _schedule(src: Inputs, **options) -> DataFrame:
    return facts.fact_trip_schedule(
        src("trips"), src("stop_times"), src("calendar"), run_at=_run_at(), **options
    )


# -- sources and sinks --------------------------------------------------------------------


@query("read_json_payload")
def read_json_payload_shapes(src: Inputs) -> DataFrame:
    """Landed JSON in each payload shape, one document per line, read back."""
    place = F.struct(F.col("c_nationkey").alias("line"), F.array("c_mktsegment").alias("tags"))
    documents = {
        "records": F.to_json(F.array(F.struct("id", "name", "tags"))),
        "data": F.to_json(F.struct(F.array(F.struct("id", "name", "tags")).alias("data"))),
        "object": F.to_json(F.struct("id", "name", "place")),
    }
    customers = src.query("select * from $customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        place.alias("place"),
        F.array("c_mktsegment", "c_name").alias("tags"),
    )
    landing = scratch_dir(src.spark, "landing")
    tagged = "id string, name string, tags string"
    nested = "id string, name string, place struct<line: bigint, tags: array<string>>"
    parts = []
    for shape, document in documents.items():
        path = f"{landing}/{shape}"
        customers.select(document.alias("value")).write.text(path)
        schema = StructType.fromDDL(nested if shape == "object" else tagged)
        rows = read_json_payload(src.spark, path, f"/{shape}", schema, shape, multi_line=False)
        detail = (
            F.concat_ws("|", F.col("`place.line`").cast("string"), F.col("`place.tags`"))
            if shape == "object"
            else F.col("tags")
        )
        parts.append(rows.select("_endpoint", "id", "name", detail.alias("detail")))
    return reduce(DataFrame.unionByName, parts)


@query("nested_to_json")
def nested_cells_to_json(src: Inputs) -> DataFrame:
    nested = src.query("select * from $customer").select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("place"),
        F.array(F.col("c_mktsegment"), F.concat(F.lit("é"), F.col("c_name"))).alias("tags"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("extra"),
    )
    return nested_to_json(nested)


@query("nested_endpoint")
def nested_endpoints(src: Inputs) -> DataFrame:
    """Payloads of nested endpoints, found in the landing and read back from raw under their entity names."""
    landing, root = scratch_dir(src.spark, "landing"), scratch_dir(src.spark, "raw")
    payloads = {
        "/facilities/schools": "select cast(c_custkey as string) id, c_name `name` from $customer",
        "/facilities/helpdesks/all/": "select cast(s_suppkey as string) id, s_name `name` from $supplier",
    }
    for endpoint, sql in payloads.items():
        document = F.to_json(F.struct(F.array(F.struct("id", "name")).alias("data")))
        rows = src.query(sql).select(document.alias("value"))
        rows.write.text(f"{landing}/{entity_name(endpoint)}")
    named = {entity_name(endpoint): endpoint for endpoint in payloads}
    parts = []
    for entity in landed_endpoints(src.spark, landing):
        path = land_endpoint(src.spark, landing, root, named[entity], "20240101", "data", multi_line=False)
        read = src.spark.read.parquet(path).select(F.lit(entity).alias("entity"), "id", "name", "_endpoint")
        parts.append(read)
    return reduce(DataFrame.unionByName, parts)


@query("read_gtfs_text")
def read_gtfs_text_member(src: Inputs) -> DataFrame:
    """A feed member written as CSV in its own column order, read back by header name."""
    path = f"{scratch_dir(src.spark, 'landing')}/gtfs/stop_times.txt"
    member = src("stop_times").select(
        "trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time", "pickup_type",
        F.col("drop_off_type").cast("double").alias("drop_off_type"), "shape_dist_traveled",
        F.lit("left out").alias("surplus"),
    )
    member.write.option("header", True).csv(path)
    return read_gtfs_text(src.spark, path, feed_schema("stop_times")).drop("_source_file")


@query("read_gtfs_text_quoted")
def read_gtfs_text_quoted(src: Inputs) -> DataFrame:
    """A feed member printed by hand: doubled quotes, commas and line breaks in quoted text."""
    path = f"{scratch_dir(src.spark, 'landing')}/gtfs/trips.txt"
    quoted = F.concat(F.lit('"'), F.replace("headsign", F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", "trip_id", quoted, "route_id")
    # A file, with its header, for every few thousand trips.
    content = F.concat(F.lit("trip_id,trip_headsign,route_id\n"), F.array_join(F.collect_list(line), "\n"))
    trips = src.query(QUOTED_TRIPS)
    files = trips.groupBy(F.floor(F.col("trip_id").cast("bigint") / 5000)).agg(content.alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    read = read_gtfs_text(src.spark, path, feed_schema("trips"), multi_line=True)
    return read.select(
        "trip_id", "trip_headsign", "route_id", "direction_id",
        F.regexp_extract("_source_file", r"^(part)-.*\.txt$", 1).alias("_source_file"),
    )


@query("dynamic_overwrite")
def dynamic_overwrite(src: Inputs) -> DataFrame:
    """Two landed days, the second landed again with other rows: the first stays."""
    root = scratch_dir(src.spark, "raw")
    raw = src("raw_trips").drop("partition_date").distinct()
    land(raw, root, "gtfs", "trips", "20240101")
    land(raw, root, "gtfs", "trips", "20240102")
    path = land(raw.withColumn("trip_headsign", F.lit("again")), root, "gtfs", "trips", "20240102")
    return read_with_schema(src.spark, path, raw_schema("trips"))


@query("schema_on_read")
def schema_on_read(src: Inputs) -> DataFrame:
    """A raw table read under its declared schema: column order, types and absent columns."""
    path = raw_path(scratch_dir(src.spark, "raw"), "gtfs", "stop_times")
    replace_partitions(src("raw_stop_times").drop("timepoint"), path)
    return read_with_schema(src.spark, path, raw_schema("stop_times"))


@query("stage_table")
def stage_table_rebuild(src: Inputs) -> DataFrame:
    """A raw table with copies staged from all days."""
    raw_root, root = scratch_dir(src.spark, "raw"), scratch_dir(src.spark, "staging")
    replace_partitions(src("raw_trips"), raw_path(raw_root, "gtfs", "trips"))
    path = stage_table(src.spark, raw_root, root, StagedTable("trips", "gtfs", "trips"), _run_at())
    return read_days(src.spark, path)


@query("stage_table_day")
def stage_table_days_again(src: Inputs) -> DataFrame:
    """Two days landed and staged again, one with fewer rows and one with none; the rest stays."""
    raw_root, root = scratch_dir(src.spark, "raw"), scratch_dir(src.spark, "staging")
    table = StagedTable("trips", "gtfs", "trips")
    raw = src("raw_trips")
    replace_partitions(raw, raw_path(raw_root, "gtfs", "trips"))
    path = stage_table(src.spark, raw_root, root, table, _run_at())
    fewer = raw.where("partition_date = '20240101' and direction_id = 0")
    for day, rows in (("20240101", fewer), ("20240102", raw.limit(0))):
        land(rows, raw_root, "gtfs", "trips", day)
        stage_table(src.spark, raw_root, root, table, _run_at(), day)
    return read_days(src.spark, path)


def _staged_on_disk(src: Inputs, *tables: StagedTable) -> str:
    raw_root, root = scratch_dir(src.spark, "raw"), scratch_dir(src.spark, "staging")
    for t in tables:
        replace_partitions(src(f"raw_{t.schema}"), raw_path(raw_root, t.source, t.entity))
        stage_table(src.spark, raw_root, root, t, _run_at())
    return root


@query("merge_staged")
def merge_staged_day_by_day(src: Inputs) -> DataFrame:
    """Staged API and feed routes merged one extraction day at a time."""
    root = _staged_on_disk(
        src,
        StagedTable("routes", "endpoint", "endpoint_routes"),
        StagedTable("routes", "gtfs", "gtfs_routes"),
    )
    for day in DAYS:
        path = merge_staged(src.spark, root, "routes", _run_at(), day=day)
    return read_days(src.spark, path)


@query("convert_staged")
def convert_staged_day_by_day(src: Inputs) -> DataFrame:
    """The JSON text columns of the staged lines as arrays, one extraction day at a time."""
    root = _staged_on_disk(src, StagedTable("lines", "endpoint", "lines"))
    for day in DAYS:
        path = convert_staged(src.spark, root, "lines", day)
    return read_days(src.spark, path)


@query("stage_all")
def stage_all_tables(src: Inputs) -> DataFrame:
    """Every feed table landed and staged; rows, and a digest of all their values, per table and day."""
    raw_root, root = scratch_dir(src.spark, "raw"), scratch_dir(src.spark, "staging")
    # Each task multiplies its rows by the days, and adds a file to each: they are not gathered.
    in_parallel(
        partial(
            replace_table, src(f"raw_{t.schema}"), raw_path(raw_root, t.source, t.entity), PARTITION_COLUMN, gather=False
        )
        for t in staged_tables()
    )
    written = stage_all(src.spark, raw_root, root, _run_at())
    found = []
    for name, path in written.items():
        rows = read_days(src.spark, path)
        content = rows.select(*feed_schema(name).fieldNames(), lineage_column(name)).schema
        found.append(
            rows.groupBy(F.lit(name).alias("table_name"), "partition_date").agg(
                F.count(F.lit(1)).alias("row_count"), portable_digest(content).alias("content")
            )
        )
    return reduce(DataFrame.unionByName, found)


def _land_day(src: Inputs, landing: str, day: str) -> None:
    """One extraction day as it comes from outside: JSON documents of the API, CSV members of the feed."""
    def land_one(t: StagedTable) -> None:
        rows = src(f"raw_{t.schema}").where(F.col("partition_date") == day)
        row = [F.col(c) for c in feed_schema(t.schema).fieldNames()]
        if t.source == "endpoint":
            # A document of one row a line, which Spark splits over many tasks.
            rows.select(F.to_json(F.array(F.struct(*row))).alias("value")).write.text(f"{landing}/{t.entity}")
        else:
            rows.select(row).write.option("header", True).csv(f"{landing}/gtfs/{t.entity}.txt")

    in_parallel(partial(land_one, t) for t in staged_tables())


@query("catalog_sql")
def catalog_sql(src: Inputs) -> DataFrame:
    """Two daily runs from landed files to snapshots, then one question in SQL over the catalog's names:
    what ran in each region and day, and how many of its stops have been renamed."""
    spark, warehouse = src.spark, scratch_dir(src.spark, "warehouse")
    for date in DAYS[:2]:
        landing = scratch_dir(spark, "landing")
        _land_day(src, landing, date.strftime("%Y%m%d"))
        run_at = dt.datetime.combine(date, dt.time(4), dt.timezone.utc)
        daily.run(spark, landing, warehouse, date, run_at, multi_line=False)
    names = daily.open_catalog(spark, warehouse)
    answer = spark.sql(
        """
        select e.region_name, cast(e.stop_event_date as string) stop_event_date, count(*) stop_events,
               count_if(t.is_peak) peak_events, count(distinct e.trip_id) trips,
               count(distinct e.stop_id) stops, count(distinct r.line_id) lines,
               count(distinct h.stop_id) renamed_stops,
               (select count(*) from staging_trips) staged_trips
        from fact_stop_event e
        join fact_trip_schedule t on t.trip_id = e.trip_id and t.trip_date = e.stop_event_date
        join dim_trip d on d.trip_id = e.trip_id
        join stg_routes r on r.route_id = d.route_id
        left join (select distinct stop_id from snapshot_dim_stop where dbt_valid_to is not null) h
               on h.stop_id = e.stop_id
        group by e.region_name, e.stop_event_date"""
    )
    written = _written(src, answer)
    # The names are this query's own; the files stay.
    for name in names:
        if not spark.catalog.dropTempView(name):
            spark.sql(f"drop table if exists {name}")
    return written


@query("fact_partitioned_sink")
def fact_partitioned_sink(src: Inputs) -> DataFrame:
    """The trip-schedule fact written by date, in buckets planned from its roll-up, and read back."""
    path = f"{scratch_dir(src.spark, 'marts')}/fact_trip_schedule"
    layout = daily.fact_layouts(src("trips"), src("stop_times"), src("calendar"))["fact_trip_schedule"]
    name = f"fact_trip_schedule_{uuid.uuid4().hex}"
    write_fact(_schedule(src, layout=layout), name, path, "trip_date", layout)
    # The catalog's entry is this query's own; the files stay.
    src.spark.sql(f"drop table {name}")
    return src.spark.read.parquet(path)


# -- cleaning -----------------------------------------------------------------------------


@query("parse_partition_date")
def parse_partition_dates(src: Inputs) -> DataFrame:
    return parse_partition_date(src("day_texts"))


@query("clean_fill")
def clean_fill(src: Inputs) -> DataFrame:
    return fill_missing(src("dirty"))


@query("json_to_array")
def json_text_to_array(src: Inputs) -> DataFrame:
    stops = src("raw_endpoint_stops").select("id", "partition_date", *ARRAY_COLUMNS["stops"])
    return json_to_array(stops, [*ARRAY_COLUMNS["stops"], "not_a_column"])


@query("dedup_full_row")
def dedup_full_row(src: Inputs) -> DataFrame:
    return fill_missing(src("dirty").select("l_suppkey", "l_linenumber", "dist", "has_pole")).dropDuplicates()


@query("sentinel_normalise")
def sentinel_normalise(src: Inputs) -> DataFrame:
    rows = src("dirty").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("has_pole").alias("anywhere"), F.col("has_pole").alias("exact"),
    )
    return normalise_sentinels(normalise_sentinels(rows, ["anywhere"]), ["exact"], exact=True)


@query("stage_rows")
def stage_rows(src: Inputs) -> DataFrame:
    """Stamp, date, fill and dedup in one chain, without I/O."""
    return stage(src("raw_gtfs_stops"), _run_at())


# -- merge and latest day -----------------------------------------------------------------


def _merged(src: Inputs, entity: str, match_partition: bool = True) -> DataFrame:
    endpoint = stage(src(f"raw_endpoint_{entity}"), _run_at())
    feed = stage(src(f"raw_gtfs_{entity}"), _run_at())
    return merge_sources(endpoint, feed, MERGES[entity], match_partition)


@query("merge_routes")
def merge_routes(src: Inputs) -> DataFrame:
    return _merged(src, "routes")


@query("merge_stops")
def merge_stops(src: Inputs) -> DataFrame:
    return _merged(src, "stops")


@query("merge_stops_all_days")
def merge_stops_all_days(src: Inputs) -> DataFrame:
    return _merged(src, "stops", match_partition=False)


@query("latest_partition")
def latest_partition_rows(src: Inputs) -> DataFrame:
    return latest_partition(src("staged_shapes"))


@query("latest_partition_on_disk")
def latest_partition_on_disk(src: Inputs) -> DataFrame:
    """The newest day of a table partitioned by it, read off its folders."""
    path = scratch_dir(src.spark, "staging")
    replace_partitions(src("staged_shapes"), path)
    return latest_partition(src.spark.read.parquet(path), day=newest_day(src.spark, path))


@query("latest_partition_anchored")
def latest_partition_anchored(src: Inputs) -> DataFrame:
    return latest_partition(src("staged_trips"), anchor=src("staged_stop_times"))


# -- functions ----------------------------------------------------------------------------


@query("gtfs_clock_time")
def gtfs_clock_times(src: Inputs) -> DataFrame:
    clock = gtfs_clock_time(F.col("departure_time"))
    return src("stop_times").select(
        "trip_id", "stop_id", "stop_sequence",
        clock.alias("clock"), clock_text(clock).alias("clock_text"),
    )


@query("gtfs_seconds")
def gtfs_seconds_of_service_day(src: Inputs) -> DataFrame:
    return src("stop_times").select(
        "trip_id", "stop_id", "stop_sequence",
        gtfs_seconds(F.col("departure_time")).alias("departure_seconds"),
        gtfs_seconds(F.col("trip_id")).alias("no_time"),
    )


@query("parse_gtfs_date")
def parse_gtfs_dates(src: Inputs) -> DataFrame:
    return src("day_numbers").select(
        "event_id", parse_gtfs_date(F.col("date")).alias("service_date")
    )


@query("peak_flag")
def peak_flags(src: Inputs) -> DataFrame:
    clock, day_type = F.col("clock"), F.col("day_type")
    exception, holiday = F.col("exception_type"), F.col("holiday")
    return src("flags").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        peak_flag(clock, day_type).alias("by_day"),
        peak_flag(clock, day_type, exception).alias("by_exception"),
        peak_flag(clock, day_type, holiday=holiday).alias("by_holiday"),
        peak_flag(clock, day_type, exception, holiday).alias("by_all"),
    )


@query("stop_event_flags")
def stop_event_flags(src: Inputs) -> DataFrame:
    return src("flags").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        is_one(F.col("holiday")).alias("is_holiday"),
        is_weekend(F.col("day_type")).alias("is_weekend"),
        is_one(F.col("school")).alias("serves_school_route"),
    )


@query("trip_duration")
def trip_durations_in_minutes(src: Inputs) -> DataFrame:
    start = gtfs_seconds(F.col("arrival_time"))
    end = gtfs_seconds(F.col("departure_time"))
    return src("stop_times").select(
        "trip_id", "stop_id", "stop_sequence",
        trip_duration_minutes(start, end).alias("forward"),
        trip_duration_minutes(end, start).alias("backward"),
    )


@query("surrogate_key")
def surrogate_keys(src: Inputs) -> DataFrame:
    return src("raw_trips").select(
        "trip_id", "partition_date",
        surrogate_key("trip_id").alias("one"),
        surrogate_key("trip_headsign", "trip_id").alias("two"),
        surrogate_key("trip_id", parse_gtfs_date(F.col("partition_date")), "calendar_desc").alias("three"),
    ).distinct()


# -- staging views ------------------------------------------------------------------------


@query("stg_calendar_service")
def stg_calendar_service(src: Inputs) -> DataFrame:
    return staging_views.stg_calendar_service(src("staged_calendar_dates"))


@query("stg_dates")
def stg_dates(src: Inputs) -> DataFrame:
    return staging_views.stg_dates(src("staged_dates"))


@query("stg_municipalities")
def stg_municipalities(src: Inputs) -> DataFrame:
    return staging_views.stg_municipalities(src("staged_municipalities"))


@query("stg_periods")
def stg_periods(src: Inputs) -> DataFrame:
    return staging_views.stg_periods(src("staged_periods"))


@query("stg_periods_anchored")
def stg_periods_anchored(src: Inputs) -> DataFrame:
    return staging_views.stg_periods(src("staged_periods"), src("staged_municipalities"))


@query("stg_routes")
def stg_routes(src: Inputs) -> DataFrame:
    return staging_views.stg_routes(json_to_array(_merged(src, "routes"), ARRAY_COLUMNS["routes"]))


@query("stg_shapes")
def stg_shapes(src: Inputs) -> DataFrame:
    return staging_views.stg_shapes(src("staged_shapes"))


@query("stg_stop_times")
def stg_stop_times(src: Inputs) -> DataFrame:
    return staging_views.stg_stop_times(src("staged_stop_times"))


@query("stg_stops")
def stg_stops(src: Inputs) -> DataFrame:
    return staging_views.stg_stops(json_to_array(_merged(src, "stops"), ARRAY_COLUMNS["stops"]))


@query("stg_trips")
def stg_trips(src: Inputs) -> DataFrame:
    return staging_views.stg_trips(src("staged_trips"))


@query("stg_trips_anchored")
def stg_trips_anchored(src: Inputs) -> DataFrame:
    return staging_views.stg_trips(src("staged_trips"), src("staged_stop_times"))


VIEW_QUERIES = {
    "stg_calendar_service": stg_calendar_service,
    "stg_dates": stg_dates,
    "stg_municipalities": stg_municipalities,
    "stg_periods": stg_periods,
    "stg_routes": stg_routes,
    "stg_shapes": stg_shapes,
    "stg_stop_times": stg_stop_times,
    "stg_stops": stg_stops,
    "stg_trips": stg_trips,
}
MERGED_VIEWS = ("stg_routes", "stg_stops")


# -- dimensions and facts -----------------------------------------------------------------


@query("dim_calendar_service")
def dim_calendar_service(src: Inputs) -> DataFrame:
    return dimensions.dim_calendar_service(
        src("dates"), src("calendar"), src("periods"), _run_at()
    )


@query("dim_line")
def dim_line(src: Inputs) -> DataFrame:
    return dimensions.dim_line(src("routes"), _run_at())


@query("dim_stop")
def dim_stop(src: Inputs) -> DataFrame:
    return dimensions.dim_stop(src("stop_rows"), _run_at())


@query("dim_trip")
def dim_trip(src: Inputs) -> DataFrame:
    return dimensions.dim_trip(src("trips"), _run_at())


@query("trip_summary")
def trip_summary(src: Inputs) -> DataFrame:
    return facts.trip_summary(src("stop_times"))


@query("trip_summary_in_sequence")
def trip_summary_in_sequence(src: Inputs) -> DataFrame:
    return facts.trip_summary(src("stop_times"), clock="sequence")


@query("trips_with_routes")
def trips_with_routes(src: Inputs) -> DataFrame:
    return facts.trips_with_routes(src("trips"), src("routes"))


@query("trips_with_dates")
def trips_with_dates(src: Inputs) -> DataFrame:
    return facts.trips_with_dates(src("trips"), src("calendar"))


@query("stops_enriched")
def stops_enriched(src: Inputs) -> DataFrame:
    return facts.stops_enriched(src("stops"), src("municipalities"))


@query("trip_peak_analysis")
def trip_peak_analysis(src: Inputs) -> DataFrame:
    return facts.trip_peak_analysis(src("stop_times"), src("trips"), src("calendar"))


@query("fact_trip_schedule")
def fact_trip_schedule(src: Inputs) -> DataFrame:
    return _schedule(src)


@query("fact_trip_schedule_active_days")
def fact_trip_schedule_active_days(src: Inputs) -> DataFrame:
    return _schedule(src, active_only=True)


@query("fact_stop_event")
def fact_stop_event(src: Inputs) -> DataFrame:
    return facts.fact_stop_event(*_fact_inputs(src), run_at=_run_at())


# -- history ------------------------------------------------------------------------------


def _kept(src: Inputs, dimension: str, before: str, after: str) -> str:
    """Where three snapshots are kept: of the dimension before, after, and as before again.

    Snapshots are taken of dimensions as written, as in a daily run.
    """
    spec = SNAPSHOTS[dimension]
    root = scratch_dir(src.spark, "snapshots")
    written = {state: _written(src, src(state)) for state in (before, after)}
    for state, at in zip((before, after, before), SNAPSHOT_TIMES):
        rows = written[state].withColumn(INGESTED_AT, F.to_timestamp(F.lit(at)))
        take_snapshot(src.spark, root, spec, rows, _utc(at))
    return root


def _utc(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def _history(src: Inputs, dimension: str, before: str, after: str) -> DataFrame:
    return read_snapshot(src.spark, _kept(src, dimension, before, after), SNAPSHOTS[dimension])


@query("snapshot_dim_line")
def snapshot_dim_line(src: Inputs) -> DataFrame:
    return _history(src, "dim_line", "lines_before", "lines_after")


@query("snapshot_dim_stop")
def snapshot_dim_stop(src: Inputs) -> DataFrame:
    return _history(src, "dim_stop", "stops_before", "stops_after")


@query("snapshot_dim_trip")
def snapshot_dim_trip(src: Inputs) -> DataFrame:
    return _history(src, "dim_trip", "trips_before", "trips_after")


@query("snapshot_as_of")
def snapshot_as_of(src: Inputs) -> DataFrame:
    root = _kept(src, "dim_stop", "stops_before", "stops_after")
    return read_as_of(src.spark, root, SNAPSHOTS["dim_stop"], _utc(AS_OF)).select(
        "stop_id", "stop_name", "municipality_id", VALID_FROM, VALID_TO
    )


# -- data quality -------------------------------------------------------------------------


@query("dq_not_null")
def dq_not_null(src: Inputs) -> DataFrame:
    schedule = _schedule(src)
    return not_null_report(schedule, not_null_columns("fact_trip_schedule", schedule))


@query("dq_unique")
def dq_unique(src: Inputs) -> DataFrame:
    events = _written(src, facts.fact_stop_event(*_fact_inputs(src), run_at=_run_at()))
    return unique_report(events, ["stop_event_key", "stop_id"])


def _written(src: Inputs, df: DataFrame) -> DataFrame:
    path = scratch_dir(src.spark, "marts")
    replace_table(df, path)
    return src.spark.read.parquet(path)


def _models(src: Inputs) -> dict[str, DataFrame]:
    """The views, marts and snapshots that checks are declared for; what is a table, as written.

    So are the views that merge sources, as a daily run writes merged tables: a view in which NULLs are found is
    passed over again.
    """
    marts = {
        "dim_calendar_service": dim_calendar_service,
        "dim_line": dim_line,
        "dim_stop": dim_stop,
        "dim_trip": dim_trip,
        "fact_trip_schedule": fact_trip_schedule,
        "fact_stop_event": fact_stop_event,
    }
    snapshots = {
        "snapshot_dim_line": snapshot_dim_line,
        "snapshot_dim_stop": snapshot_dim_stop,
        "snapshot_dim_trip": snapshot_dim_trip,
    }
    views = {name: make(src) for name, make in VIEW_QUERIES.items() if name not in MERGED_VIEWS}
    merged = {name: VIEW_QUERIES[name] for name in MERGED_VIEWS}
    written = in_parallel(
        [
            *(partial(lambda make: _written(src, make(src)), make) for make in [*marts.values(), *merged.values()]),
            *(partial(make, src) for make in snapshots.values()),
        ]
    )
    return {**views, **dict(zip([*marts, *merged, *snapshots], written, strict=True))}


@query("dq_all")
def dq_all(src: Inputs) -> DataFrame:
    """Every declared check of every model."""
    return daily.check_all(src.spark, _models(src))


@query("dq_contract")
def dq_contract(src: Inputs) -> DataFrame:
    """What the four promised schemas find: nothing in the models, three faults in a broken view."""
    models = {
        "fact_trip_schedule": _schedule(src),
        "dim_calendar_service": dim_calendar_service(src),
        "stg_municipalities": stg_municipalities(src),
        "stg_calendar_service": stg_calendar_service(src),
    }
    found = [
        (name, *fault)
        for name, df in models.items()
        for fault in contract_violations(df.schema, contract(name))
    ]
    broken = models["stg_municipalities"].drop("region_name").withColumns(
        {"district_id": F.col("district_id").cast("string"), "surplus": F.lit(1)}
    )
    faults = contract_violations(broken.schema, contract("stg_municipalities"))
    found += [("broken stg_municipalities", *fault) for fault in faults]
    columns = "model string, column_name string, promised string, found string"
    return src.spark.createDataFrame(found, columns)


# -- analyses -----------------------------------------------------------------------------


@query("avgtime_trip")
def avgtime_trip(src: Inputs) -> DataFrame:
    durations = rollups.trip_durations(src("trips"), src("stop_times"), src("calendar"))
    return analyses.avgtime_trip(durations, rollups.TRIP_COUNT)


@query("daily_line_frequency")
def daily_line_frequency(src: Inputs) -> DataFrame:
    events = rollups.stop_events_per_day(*_fact_inputs(src))
    return analyses.daily_line_frequency(events, rollups.STOP_EVENT_COUNT)


@query("distance_trip")
def distance_trip(src: Inputs) -> DataFrame:
    return analyses.distance_trip(_schedule(src))


@query("line_frequency")
def line_frequency(src: Inputs) -> DataFrame:
    return rollups.line_frequency_at_stops(*_fact_inputs(src), LINE_ID)


@query("peak_schedule")
def peak_schedule(src: Inputs) -> DataFrame:
    by_peak = rollups.trips_by_peak(src("trips"), src("stop_times"), src("calendar"))
    return analyses.peak_schedule(by_peak, rollups.TRIP_COUNT)


@query("stops_by_municipality")
def stops_by_municipality(src: Inputs) -> DataFrame:
    return analyses.stops_by_municipality(rollups.stops_served(*_fact_inputs(src)))


@query("stops_by_region")
def stops_by_region(src: Inputs) -> DataFrame:
    return analyses.stops_by_region(rollups.stops_served(*_fact_inputs(src)))


@query("stops_near_school")
def stops_near_school(src: Inputs) -> DataFrame:
    events = rollups.stop_events_per_day(*_fact_inputs(src))
    return analyses.stops_near_school(events, rollups.STOP_EVENT_COUNT)


@query("top10_lines_for_stop")
def top10_lines_for_stop(src: Inputs) -> DataFrame:
    return analyses.top10_lines_for_stop(rollups.lines_per_stop(*_fact_inputs(src)))


@query("trips_by_date")
def trips_by_date(src: Inputs) -> DataFrame:
    per_day = rollups.trips_per_day(src("trips"), src("calendar"))
    return analyses.trips_by_date(per_day, rollups.TRIP_COUNT)


@query("which_lines_for_each_stop")
def which_lines_for_each_stop(src: Inputs) -> DataFrame:
    return analyses.which_lines_for_each_stop(rollups.lines_per_stop(*_fact_inputs(src)))
