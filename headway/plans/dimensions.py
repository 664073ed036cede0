"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.keys import surrogate_key
from headway.schemas import INGESTED_AT


def dim_calendar_service(
    dates: DataFrame, calendar: DataFrame, periods: DataFrame, run_at: Column | None = None
) -> DataFrame:
    """One row per day, service running on it, and season the day lies in."""
    d = dates.select("date", "period")
    c = calendar.select("date", "service_id", "service_date")
    p = periods.select("period_id", "period_name")
    return (
        c.join(d, "date")
        .join(p, d.period == p.period_id)
        .select(
            surrogate_key("date", "service_id", "period_id").alias("calendar_service_key"),
            "service_date",
            "date",
            "service_id",
            "period_id",
            "period_name",
            _stamp(run_at),
        )
    )


def dim_line(routes: DataFrame, run_at: Column | None = None) -> DataFrame:
    """One row per route, with the line it belongs to."""
    return routes.select(
        surrogate_key("route_id").alias("route_key"),
        "route_id",
        "route_long_name",
        "route_short_name",
        "route_type",
        "route_color",
        "route_text_color",
        "line_id",
        "line_long_name",
        "line_short_name",
        "line_type",
        "agency_id",
        "tts_name",
        "circular",
        "school",
        _stamp(run_at),
    )


STOP_ATTRIBUTES = (
    "stop_name",
    "stop_latitude",
    "stop_longitude",
    "municipality_id",
    "municipality_name",
    "region_id",
    "region_name",
    "near_school",
)


def dim_stop(stops: DataFrame, run_at: Column | None = None) -> DataFrame:
    """One row per stop: the earliest loaded, and among those the least by its attributes.

    The pick is a minimum over a struct, not a ranking window: it combines map-side,
    so the copies of one stop never meet in a single task.
    """
    ranked = F.struct(INGESTED_AT, *STOP_ATTRIBUTES)
    first = stops.groupBy("stop_id").agg(F.min(ranked).alias("first"))
    return first.select(
        surrogate_key("stop_id").alias("stop_key"),
        "stop_id",
        *(F.col(f"first.{c}").alias(c) for c in STOP_ATTRIBUTES),
        _stamp(run_at),
    )


def dim_trip(trips: DataFrame, run_at: Column | None = None) -> DataFrame:
    """One row per trip, whatever days it runs on."""
    return trips.select(
        surrogate_key("trip_id").alias("trip_key"),
        "trip_id",
        F.col("direction_id").alias("direction"),
        "route_id",
        "service_id",
        "trip_headsign",
        "pattern_id",
        "shape_id",
        _stamp(run_at),
    )


def _stamp(run_at: Column | None) -> Column:
    return (F.current_timestamp() if run_at is None else run_at).alias(INGESTED_AT)
