"""One day's run: landed files to raw, staging, marts, snapshots and checks.

Each stage writes its tables and the next reads them back, so a stage can be run
again on its own, plans stay short, and every scan knows its size on disk.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.history import SNAPSHOTS
from headway.operators.latest import newest_day
from headway.operators.merge import MERGES
from headway.operators.quality import enforce_contract
from headway.plans.contracts import CONTRACTS, check_model, contract
from headway.plans.dimensions import dim_calendar_service, dim_line, dim_stop, dim_trip
from headway.plans.facts import fact_stop_event, fact_trip_schedule
from headway.plans import rollups
from headway.plans.snapshots import read_snapshot, snapshot_dimensions
from headway.plans.staging_views import VIEWS
from headway.sources.fact_tables import (
    FactLayout,
    is_laid_out,
    open_fact,
    plan_layout,
    write_fact,
)
from headway.sources.landing import gtfs_members, land_endpoint, land_gtfs, landed_endpoints
from headway.sources.staging import (
    ARRAY_COLUMNS,
    ENTITIES,
    convert_staged,
    merge_staged,
    read_staged,
    stage_all,
    staging_path,
)
from headway.sources.tables import entity_name, in_parallel, register_views, replace_table

FACT_PARTITIONS = {"fact_trip_schedule": "trip_date", "fact_stop_event": "stop_event_date"}
#: Bytes of a row as written: the key, a hash in text, takes most of it.
FACT_ROW_BYTES = {"fact_trip_schedule": 50.0, "fact_stop_event": 55.0}
CHECKS = "model string, column_name string, check_name string, failures bigint"
MART_TABLES = (
    "dim_calendar_service",
    "dim_line",
    "dim_stop",
    "dim_trip",
    "fact_trip_schedule",
    "fact_stop_event",
)


def run(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    run_date: dt.date,
    run_at: dt.datetime | None = None,
    full_refresh: bool = False,
    payload_shapes: Mapping[str, str] | None = None,
    extra_endpoints: Sequence[str] = (),
    anchors: Mapping[str, str] | None = None,
    active_only: bool = False,
    clock: str = "wrapped",
    match_partition: bool = True,
    multi_line: bool = True,
    multi_line_text: bool = False,
    gather_facts: bool = False,
) -> DataFrame:
    """Process the files landed on `run_date` and return the report of the declared checks.

    By default staging touches only the new extraction day; `full_refresh` rebuilds
    it from all raw days. `payload_shapes` names the JSON shape of an entity where it
    is not a plain list of rows. `extra_endpoints` are landed in the raw layer only, as is
    every other file or folder of the landing.

    anchors: views that take the latest day from another table, such as CROSS_ANCHORS.
    active_only, clock: see the facts. match_partition: see `merge_staged`; without it the
    merged tables are rebuilt from all days. multi_line, multi_line_text: see the readers.
    gather_facts: see `build_marts`.

    The views and marts are checked before the snapshots are taken; a dimension that fails
    a check of its own is not snapshotted, and the report says why. A run can be repeated
    after a failure: what it had done comes out the same.
    """
    run_at = run_at or dt.datetime.now(dt.timezone.utc)
    stamp = F.lit(run_at).cast("timestamp")
    day = run_date.strftime("%Y%m%d")
    raw, staging = f"{warehouse}/raw", f"{warehouse}/staging"

    shapes = payload_shapes or {}
    land_all(spark, landing, raw, day, shapes, extra_endpoints, multi_line, multi_line_text)
    stage_all(spark, raw, staging, stamp, None if full_refresh else day)
    one_day = None if full_refresh or not match_partition else run_date
    in_parallel(
        partial(merge_staged, spark, staging, entity, stamp, match_partition, one_day)
        for entity in MERGES
    )
    in_parallel(
        partial(convert_staged, spark, staging, table, day=one_day) for table in ARRAY_COLUMNS
    )
    build_marts(spark, warehouse, stamp, anchors, active_only, clock, gather_facts)
    marts = read_marts(spark, warehouse)
    found = check_all(spark, {**staging_views(spark, warehouse, anchors), **marts})
    faulty = {r.model for r in failed(found).select("model").distinct().collect()}
    sound = {name: marts[name] for name in SNAPSHOTS if name not in faulty}
    snapshot_dimensions(spark, f"{warehouse}/snapshots", sound, run_at)
    taken = {
        spec.name: read_snapshot(spark, f"{warehouse}/snapshots", spec)
        for name, spec in SNAPSHOTS.items()
        if name in sound
    }
    return found.unionByName(check_all(spark, taken)) if taken else found


def land_all(
    spark: SparkSession,
    landing: str,
    raw: str,
    day: str,
    shapes: Mapping[str, str],
    extra_endpoints: Sequence[str] = (),
    multi_line: bool = True,
    multi_line_text: bool = False,
) -> None:
    """Land the API entities that staging reads, all others that are there, and every feed member."""
    needed = [f"/{entity}" for entity, sources in ENTITIES.items() if "endpoint" in sources]
    endpoints = {entity_name(e): e for e in (*needed, *extra_endpoints)}
    for entity in landed_endpoints(spark, landing):
        endpoints.setdefault(entity, f"/{entity.replace('facilities_', 'facilities/', 1)}")
    payloads = [
        partial(
            land_endpoint, spark, landing, raw, e, day, shapes.get(entity, "records"), multi_line
        )
        for entity, e in endpoints.items()
    ]
    members = [
        partial(land_gtfs, spark, landing, raw, member, day, multi_line_text)
        for member in gtfs_members(spark, landing)
    ]
    in_parallel([*payloads, *members])


def staging_views(
    spark: SparkSession, warehouse: str, anchors: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """The stg_* views over the staged tables. `anchors` maps a view to another table to anchor on."""
    anchors = anchors or {}
    views = {}
    for name, (table, view) in VIEWS.items():
        day = newest_day(spark, _staged_path(warehouse, anchors.get(name, table)))
        views[name] = view(_staged(spark, warehouse, table), day=day)
        if name in CONTRACTS:
            views[name] = enforce_contract(views[name], contract(name), name)
    return views


def build_marts(
    spark: SparkSession,
    warehouse: str,
    run_at: Column,
    anchors: Mapping[str, str] | None = None,
    active_only: bool = False,
    clock: str = "wrapped",
    gather_facts: bool = False,
) -> None:
    """Write the dimensions, then the facts; the stop-event fact reads the stop dimension back.

    The facts are bucketed by trip, with as many files a day as the largest day takes, planned from the
    roll-ups. That holds while Spark broadcasts the calendar; where it is larger, gather_facts gathers
    the rows of a day before they are written: few files a day, for a shuffle of the multiplied rows.
    """
    v = staging_views(spark, warehouse, anchors)
    trips, stop_times, calendar = (
        v["stg_trips"], v["stg_stop_times"], v["stg_calendar_service"]
    )
    calendar_service = enforce_contract(
        dim_calendar_service(v["stg_dates"], calendar, v["stg_periods"], run_at),
        contract("dim_calendar_service"),
        "dim_calendar_service",
    )

    running = calendar.where("exception_type = 1") if active_only else calendar
    layouts = {} if gather_facts else fact_layouts(trips, stop_times, running)

    def write(name: str, df: DataFrame) -> None:
        path = f"{warehouse}/marts/{name}"
        if name in layouts:
            write_fact(df, name, path, FACT_PARTITIONS[name], layouts[name])
        else:
            replace_table(df, path, FACT_PARTITIONS.get(name))

    independent = {
        "dim_calendar_service": calendar_service,
        "dim_line": dim_line(v["stg_routes"], run_at),
        "dim_stop": dim_stop(v["stg_stops"], run_at),
        "dim_trip": dim_trip(trips, run_at),
        "fact_trip_schedule": fact_trip_schedule(
            trips, stop_times, calendar, clock, active_only, run_at, layouts.get("fact_trip_schedule")
        ),
    }
    in_parallel(partial(write, name, df) for name, df in independent.items())
    stops = spark.read.parquet(f"{warehouse}/marts/dim_stop")
    write(
        "fact_stop_event",
        fact_stop_event(
            stop_times,
            trips,
            v["stg_routes"],
            calendar,
            stops,
            v["stg_municipalities"],
            active_only,
            run_at,
            layouts.get("fact_stop_event"),
        ),
    )


def fact_layouts(
    trips: DataFrame, stop_times: DataFrame, calendar: DataFrame
) -> dict[str, FactLayout]:
    """How the two facts are to lie on disk: both by trip, a day in as many files as it needs."""
    counts = {
        "fact_trip_schedule": (rollups.trips_per_day(trips, calendar), rollups.TRIP_COUNT),
        "fact_stop_event": (
            rollups.stop_events_by_date(stop_times, trips, calendar),
            rollups.STOP_EVENT_COUNT,
        ),
    }
    return {
        name: plan_layout(per_day, "trip_id", FACT_PARTITIONS[name], rows, FACT_ROW_BYTES[name])
        for name, (per_day, rows) in counts.items()
    }


def read_marts(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The mart tables as written."""
    return {name: spark.read.parquet(f"{warehouse}/marts/{name}") for name in MART_TABLES}


def read_snapshots(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    return {s.name: read_snapshot(spark, f"{warehouse}/snapshots", s) for s in SNAPSHOTS.values()}


def open_catalog(spark: SparkSession, warehouse: str) -> list[str]:
    """Register staged tables, staging views, marts and snapshots for SQL under their names."""
    sources = sorted({table for table, _ in VIEWS.values()})
    tables = {
        **{f"staging_{t}": _staged(spark, warehouse, t) for t in sources},
        **staging_views(spark, warehouse),
        **read_marts(spark, warehouse),
        **read_snapshots(spark, warehouse),
    }
    register_views(tables)
    for name in FACT_PARTITIONS:
        path = f"{warehouse}/marts/{name}"
        if is_laid_out(spark, path):
            # A view would hide the buckets that joins on the trip go by.
            spark.catalog.dropTempView(name)
            open_fact(spark, name, path)
    return sorted(tables)


def check_all(spark: SparkSession, models: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared check of the given models with the number of failures.

    Each model is passed over once; a few models are checked at a time.
    """
    found = in_parallel(partial(check_model, name, df) for name, df in models.items())
    return spark.createDataFrame([row for rows in found for row in rows], CHECKS)


def _staged_path(warehouse: str, table: str) -> str:
    return staging_path(f"{warehouse}/staging", table)


def _staged(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    return read_staged(spark, f"{warehouse}/staging", table)


def failed(report: DataFrame) -> DataFrame:
    """The checks that found something."""
    return report.where(F.col("failures") > 0)


