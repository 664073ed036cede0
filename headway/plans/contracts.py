"""Declared checks of the models: promised schemas, columns never NULL, columns never repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from headway.operators.quality import check_columns
from headway.schemas import columns

# Models whose schema is promised. Clock times are seconds of day.
CONTRACTS = {
    "fact_trip_schedule": """
        trip_key string, trip_id string, trip_date date, route_id string, pattern_id string,
        shape_id string, service_id string, direction_id bigint, trip_headsign string,
        departure_time bigint, arrival_time bigint, duration_minutes double, is_peak boolean,
        distance_km double, total_stops bigint, ingested_at timestamp""",
    "dim_calendar_service": """
        calendar_service_key string, service_date date, date bigint, service_id string,
        period_id bigint, period_name string, ingested_at timestamp""",
    "stg_municipalities": """
        district_id bigint, district_name string, municipality_id bigint,
        municipality_name string, municipality_prefix bigint, region_id string,
        region_name string, _source_file string, ingested_at timestamp,
        partition_date date""",
    "stg_calendar_service": """
        service_date date, date bigint, day_type bigint, exception_type bigint,
        holiday bigint, period bigint, service_id string, _source_file string,
        ingested_at timestamp, partition_date date""",
}

ALL = "all"

# Columns that must not be NULL, per model.
NOT_NULL = {
    "stg_periods": ALL,
    "stg_shapes": ALL,
    "stg_municipalities": ALL,
    "stg_calendar_service": ALL,
    "stg_dates": ALL,
    "stg_stop_times": ALL,
    "stg_trips": ALL,
    "stg_routes": """
        route_id line_id locality_ids pattern_ids region_ids partition_date ingested_at""",
    "stg_stops": "stop_id ingested_at partition_date",
    "fact_trip_schedule": ALL,
    "dim_calendar_service": ALL,
    "dim_stop": ALL,
    "fact_stop_event": "stop_event_key stop_event_date stop_id is_near_school ingested_at",
    "dim_trip": ALL,
    "dim_line": "route_key route_id line_id ingested_at",
    "snapshot_dim_stop": "stop_id",
    "snapshot_dim_line": "route_id",
    "snapshot_dim_trip": "trip_id",
}

# Columns whose values must not repeat, per model.
UNIQUE = {
    "stg_trips": "trip_id",
    "stg_routes": "route_id",
    "fact_trip_schedule": "trip_key",
    "dim_calendar_service": "calendar_service_key",
    "dim_stop": "stop_key stop_id",
    "fact_stop_event": "stop_event_key",
    "dim_trip": "trip_key trip_id",
    "dim_line": "route_key route_id",
}


def contract(model: str) -> StructType:
    return columns(CONTRACTS[model])


def not_null_columns(model: str, df: DataFrame) -> list[str]:
    declared = NOT_NULL.get(model, "")
    return df.columns if declared == ALL else declared.split()


def unique_columns(model: str) -> list[str]:
    return UNIQUE.get(model, "").split()


def check_model(model: str, df: DataFrame) -> list[tuple[str, str, str, int]]:
    """(model, column, check, failures) of each declared check of `model`, in one pass over it."""
    found = check_columns(df, not_null_columns(model, df), unique_columns(model))
    return [(model, *check) for check in found]
