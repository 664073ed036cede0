"""Facts of the star schema: scheduled trips per day, and stop events per day.

How the plans hold up on large feeds
- The calendar multiplies rows (trips x service days). It is joined last, so the
  multiplied rows are never shuffled by the joins before it.
- There are no broadcast hints. Catalyst broadcasts a side whose size it knows to be
  under spark.sql.autoBroadcastJoinThreshold, adaptive execution one whose measured
  size is; beyond that the join is a shuffle join, and adaptive execution splits a
  partition that one hot key fills (the other side of each join here holds a key once,
  or is the calendar, so every such split is allowed).
- Stop times are reduced to one row per trip before they meet anything else in the
  trip schedule. The first departure decides the peak flag, and the calendar drops no
  stop time, so its minimum per trip is also the minimum per trip and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.gtfs import (
    clock_of,
    gtfs_seconds,
    is_one,
    is_weekend,
    peak_flag,
    trip_duration_minutes,
)
from headway.functions.keys import surrogate_key
from headway.operators.quality import enforce_contract
from headway.plans.contracts import contract
from headway.plans.dimensions import _stamp
from headway.sources.fact_tables import FactLayout, on_days

REGULAR_DAY = 1


def trip_summary(stop_times: DataFrame, clock: str = "wrapped") -> DataFrame:
    """Begin, end, duration, distance and number of stops of each trip.

    clock: `wrapped` takes the least departure and greatest arrival on the wall
    clock, so a trip past midnight begins at its first departure after midnight;
    `sequence` takes the first and last in running order.
    """
    # Parsed in a projection of its own: each text once, however many aggregates read it.
    timed = stop_times.select(
        "trip_id",
        "shape_dist_traveled",
        gtfs_seconds(F.col("departure_time")).alias("departure"),
        gtfs_seconds(F.col("arrival_time")).alias("arrival"),
    )
    departure, arrival = F.col("departure"), F.col("arrival")
    if clock == "wrapped":
        begin, end = F.min(clock_of(departure)), F.max(clock_of(arrival))
    elif clock == "sequence":
        begin, end = clock_of(F.min(departure)), clock_of(F.max(arrival))
    else:
        raise ValueError(f"unknown clock: {clock}")
    return timed.groupBy("trip_id").agg(
        begin.alias("departure_time_begin"),
        end.alias("arrival_time_end"),
        trip_duration_minutes(F.min(departure), F.max(arrival)).alias("duration_minutes"),
        F.round(F.max("shape_dist_traveled"), 2).alias("distance_km"),
        F.count(F.lit(1)).alias("total_stops"),
    )


def trips_with_routes(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Trips with the names of their route and line."""
    return trips.select("trip_id", "route_id", "service_id").join(
        routes.select(
            "route_id",
            "route_long_name",
            "route_short_name",
            "line_id",
            "line_long_name",
            "line_short_name",
            "school",
        ),
        "route_id",
    )


def trips_with_dates(
    trips: DataFrame, calendar: DataFrame, layout: FactLayout | None = None
) -> DataFrame:
    """Trips once per day their service runs; laid out for writing where a layout is given."""
    days = calendar.select(
        "service_id", "service_date", "date", "day_type", "exception_type", "holiday"
    )
    return on_days(trips, days, layout)


def stops_enriched(stops: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Stops with their district; a stop without a numeric municipality drops out."""
    s = stops.select(
        "stop_id",
        "stop_name",
        "municipality_id",
        "municipality_name",
        "region_id",
        "region_name",
        "near_school",
    )
    m = municipalities.select(
        F.col("municipality_id").alias("_municipality"), "district_id", "district_name"
    )
    return s.join(m, s.municipality_id.try_cast("bigint") == m._municipality).drop("_municipality")


def trip_peak_analysis(
    stop_times: DataFrame, trips: DataFrame, calendar: DataFrame
) -> DataFrame:
    """First departure and peak flag of each trip with stop times, per day it runs."""
    first = stop_times.groupBy("trip_id").agg(
        F.min(clock_of(gtfs_seconds(F.col("departure_time")))).alias("first_departure")
    )
    days = calendar.select("service_id", "service_date", "day_type", "exception_type", "holiday")
    per_day = (
        first.join(trips.select("trip_id", "service_id"), "trip_id")
        .join(days, "service_id")
        .groupBy("trip_id", "service_date", "day_type", "exception_type", "holiday")
        .agg(F.min("first_departure").alias("first_departure"))
    )
    return per_day.select(
        "trip_id",
        "service_date",
        "first_departure",
        "day_type",
        "exception_type",
        "holiday",
        peak_flag(
            F.col("first_departure"), F.col("day_type"), F.col("exception_type"), F.col("holiday")
        ).alias("is_peak"),
    )


def fact_trip_schedule(
    trips: DataFrame,
    stop_times: DataFrame,
    calendar: DataFrame,
    clock: str = "wrapped",
    active_only: bool = False,
    run_at: Column | None = None,
    layout: FactLayout | None = None,
) -> DataFrame:
    """One row per trip and day its service runs.

    A trip without stop times keeps NULL times, duration and stop count, distance 0
    and an off-peak flag. `active_only` leaves out calendar rows that remove a day
    from a service; by default they count as days. `layout`: how the rows are to lie
    when they are written.
    """
    days = calendar.select("service_id", "service_date", "day_type", "exception_type", "holiday")
    if active_only:
        days = days.where(F.col("exception_type") == REGULAR_DAY)
    scheduled = trips.select(
        "trip_id",
        "route_id",
        "pattern_id",
        "shape_id",
        "service_id",
        "direction_id",
        "trip_headsign",
    ).join(trip_summary(stop_times, clock), "trip_id", "left")
    fact = on_days(scheduled, days, layout).select(
        surrogate_key("trip_id", "service_date").alias("trip_key"),
        "trip_id",
        F.col("service_date").alias("trip_date"),
        "route_id",
        "pattern_id",
        "shape_id",
        "service_id",
        "direction_id",
        "trip_headsign",
        F.col("departure_time_begin").alias("departure_time"),
        F.col("arrival_time_end").alias("arrival_time"),
        "duration_minutes",
        peak_flag(
            F.col("departure_time_begin"),
            F.col("day_type"),
            F.col("exception_type"),
            F.col("holiday"),
        ).alias("is_peak"),
        F.coalesce("distance_km", F.lit(0.0)).alias("distance_km"),
        "total_stops",
        _stamp(run_at),
    )
    return enforce_contract(fact, contract("fact_trip_schedule"), "fact_trip_schedule")


def fact_stop_event(
    stop_times: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    calendar: DataFrame,
    stops: DataFrame,
    municipalities: DataFrame,
    active_only: bool = False,
    run_at: Column | None = None,
    layout: FactLayout | None = None,
) -> DataFrame:
    """One row per stop of a trip and day its service runs. `layout`: as for the trip schedule."""
    if active_only:
        calendar = calendar.where(F.col("exception_type") == REGULAR_DAY)
    # Stops first, and merged: the rows of one stop then lie together when they are shuffled by trip, so that its names
    # pack well. A trip has too few rows for that the other way round, and a broadcast leaves rows where they lie.
    calls = (
        stop_times.select("trip_id", "stop_id", "stop_sequence", "pickup_type", "drop_off_type")
        .join(stops_enriched(stops, municipalities).hint("merge"), "stop_id")
        .join(trips_with_routes(trips, routes), "trip_id")
    )
    return trips_with_dates(calls, calendar, layout).select(
        surrogate_key("stop_id", "trip_id", "service_date", "stop_sequence").alias(
            "stop_event_key"
        ),
        F.col("service_date").alias("stop_event_date"),
        "stop_id",
        "stop_name",
        "municipality_id",
        "municipality_name",
        "region_id",
        "region_name",
        "district_id",
        "district_name",
        "line_id",
        "line_long_name",
        "line_short_name",
        "route_id",
        "route_long_name",
        "route_short_name",
        "trip_id",
        "stop_sequence",
        "pickup_type",
        "drop_off_type",
        is_one(F.col("near_school")).alias("is_near_school"),
        is_one(F.col("holiday")).alias("is_holiday"),
        is_weekend(F.col("day_type")).alias("is_weekend"),
        is_one(F.col("school")).alias("serves_school_route"),
        F.lit(1).alias("stop_event_count"),
        _stamp(run_at),
    )
