"""Pre-aggregated forms of the two facts, for the analyses.

An analysis adds up a fact. Where only the answer is wanted, most of the adding can
happen before the calendar multiplies the rows: trips and stop events are counted
per service first, then each count meets the days of its service. Counts only ever
get multiplied and added, so the answers are those over the fact, while the rows
that meet the calendar number (groups x services), not (trips x days). It also takes
the many-to-many join on `service_id`, a key of few values, off the raw rows.

Each roll-up has the columns of its fact that it groups by, and a count column that
the analyses add up in place of counting rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.gtfs import in_peak_window, is_one, is_peak_day
from headway.plans.facts import (
    stops_enriched,
    trip_summary,
    trips_with_dates,
    trips_with_routes,
)

TRIP_COUNT = "trip_count"
STOP_EVENT_COUNT = "stop_event_count"


def trips_per_day(trips: DataFrame, calendar: DataFrame) -> DataFrame:
    """(trip_date, trip_count): scheduled trips per service and day."""
    per_service = trips.groupBy("service_id").agg(F.count(F.lit(1)).alias(TRIP_COUNT))
    days = calendar.select("service_id", F.col("service_date").alias("trip_date"))
    return per_service.join(days, "service_id").select("trip_date", TRIP_COUNT)


def stop_events_by_date(
    stop_times: DataFrame, trips: DataFrame, calendar: DataFrame
) -> DataFrame:
    """(stop_event_date, stop_event_count): stop events per service and day, before any stop or route is left out."""
    calls = stop_times.groupBy("trip_id").agg(F.count(F.lit(1)).alias("_calls"))
    per_service = (
        trips.select("trip_id", "service_id")
        .join(calls, "trip_id")
        .groupBy("service_id")
        .agg(F.sum("_calls").alias(STOP_EVENT_COUNT))
    )
    days = calendar.select("service_id", F.col("service_date").alias("stop_event_date"))
    return per_service.join(days, "service_id").select("stop_event_date", STOP_EVENT_COUNT)


def trip_durations(trips: DataFrame, stop_times: DataFrame, calendar: DataFrame) -> DataFrame:
    """(duration_minutes, trip_count): trip days per service and duration."""
    summary = trip_summary(stop_times).select("trip_id", "duration_minutes")
    per_service = (
        trips.select("trip_id", "service_id")
        .join(summary, "trip_id", "left")
        .groupBy("service_id", "duration_minutes")
        .agg(F.count(F.lit(1)).alias("_trips"))
    )
    days = calendar.groupBy("service_id").agg(F.count(F.lit(1)).alias("_days"))
    return per_service.join(days, "service_id").select(
        "duration_minutes", (F.col("_trips") * F.col("_days")).alias(TRIP_COUNT)
    )


def trips_by_peak(trips: DataFrame, stop_times: DataFrame, calendar: DataFrame) -> DataFrame:
    """(is_peak, trip_count): trip days per service, day and peak flag."""
    summary = trip_summary(stop_times).select("trip_id", "departure_time_begin")
    per_service = (
        trips.select("trip_id", "service_id")
        .join(summary, "trip_id", "left")
        .groupBy("service_id", in_peak_window(F.col("departure_time_begin")).alias("_at_peak"))
        .agg(F.count(F.lit(1)).alias(TRIP_COUNT))
    )
    peak_day = is_peak_day(F.col("day_type"), F.col("exception_type"), F.col("holiday"))
    return trips_with_dates(per_service, calendar).select(
        (F.col("_at_peak") & peak_day).alias("is_peak"), TRIP_COUNT
    )


def _running(trips: DataFrame, calendar: DataFrame) -> DataFrame:
    """Trips whose service runs on some day. A semi join: the calendar multiplies nothing."""
    return trips.join(calendar.select("service_id").distinct(), "service_id", "left_semi")


def stop_events_per_day(
    stop_times: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    calendar: DataFrame,
    stops: DataFrame,
    municipalities: DataFrame,
) -> DataFrame:
    """Stop events per stop, line, service and day."""
    calls = (
        stop_times.select("trip_id", "stop_id")
        .join(trips_with_routes(trips, routes), "trip_id")
        .groupBy("stop_id", "service_id", "line_id", "line_long_name", "line_short_name")
        .agg(F.count(F.lit(1)).alias(STOP_EVENT_COUNT))
        .join(stops_enriched(stops, municipalities), "stop_id")
    )
    return trips_with_dates(calls, calendar).select(
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
        is_one(F.col("near_school")).alias("is_near_school"),
        STOP_EVENT_COUNT,
    )


def lines_per_stop(
    stop_times: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    calendar: DataFrame,
    stops: DataFrame,
    municipalities: DataFrame,
) -> DataFrame:
    """Stops and the lines that call there on some day, each pair once; no dates, no counts."""
    lines = (
        stop_times.select("trip_id", "stop_id")
        .join(trips_with_routes(_running(trips, calendar), routes), "trip_id")
        .select("stop_id", "line_id", "line_long_name", "line_short_name")
        .distinct()
    )
    return lines.join(stops_enriched(stops, municipalities), "stop_id")


def stops_served(
    stop_times: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    calendar: DataFrame,
    stops: DataFrame,
    municipalities: DataFrame,
) -> DataFrame:
    """Stops where some trip of a known route calls on some day, each once."""
    known = _running(trips, calendar).join(routes, "route_id", "left_semi")
    called = (
        stop_times.select("trip_id", "stop_id")
        .join(known, "trip_id", "left_semi")
        .select("stop_id")
        .distinct()
    )
    return called.join(stops_enriched(stops, municipalities), "stop_id")


def line_frequency_at_stops(
    stop_times: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    calendar: DataFrame,
    stops: DataFrame,
    municipalities: DataFrame,
    line_id: str,
) -> DataFrame:
    """The analysis `line_frequency`, without making the events.

    Distinct trips are counted before the calendar and days after it, so neither
    count sees (trips x days) rows. The line and the services that run at all are
    picked among the trips, before these meet the stop times.
    """
    days = calendar.select("service_id", "service_date")
    of_line = trips_with_routes(
        _running(trips, calendar), routes.where(F.col("line_id") == line_id)
    ).select("trip_id", "service_id")
    per_trip = (
        stop_times.select("trip_id", "stop_id")
        .join(of_line, "trip_id")
        .groupBy("stop_id", "trip_id", "service_id")
        .agg(F.count(F.lit(1)).alias("_calls"))
    )
    by_day = (
        per_trip.groupBy("stop_id", "service_id")
        .agg(F.sum("_calls").alias("_calls"))
        .join(days, "service_id")
        .groupBy("stop_id")
        .agg(
            F.sum("_calls").alias("total_frequency"),
            F.count_distinct("service_date").alias("days_served"),
            F.min("service_date").alias("first_service_date"),
            F.max("service_date").alias("last_service_date"),
        )
    )
    # Reading the call count keeps this branch's aggregate equal to the other's, so
    # that Spark runs and shuffles it once for both.
    called = F.when(F.col("_calls") > 0, F.col("trip_id"))
    by_trip = per_trip.groupBy("stop_id").agg(F.count_distinct(called).alias("unique_trips"))
    named = stops_enriched(stops, municipalities).select(
        "stop_id", "stop_name", "municipality_name"
    )
    return (
        by_day.join(by_trip, "stop_id")
        .join(named, "stop_id")
        .select(
            "stop_id",
            "stop_name",
            "municipality_name",
            "total_frequency",
            "days_served",
            (F.col("total_frequency") / F.col("days_served")).alias("avg_frequency_per_day"),
            "unique_trips",
            "first_service_date",
            "last_service_date",
        )
        .orderBy(F.desc("total_frequency"), "stop_id")
    )
