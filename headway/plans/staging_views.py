"""Views over the latest extraction day of the staged tables.

Views are lazy DataFrames: a model that reads one gets the partition filter and
its own column selection pushed into the scan. `anchor` is the staged table whose
newest day counts; each view anchors on its own table unless told otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.gtfs import parse_gtfs_date
from headway.operators.cleaning import NAN_SENTINEL, STOP_SENTINELS, normalise_sentinels
from headway.operators.latest import latest_partition

# The columns of the two wide views, and those whose sentinels are printed as N/A.
ROUTE_COLUMNS = """
    route_id route_long_name route_short_name route_type route_color route_text_color
    line_id line_long_name line_short_name line_type tts_name agency_id circular path_type
    school district_ids facilities locality_ids municipality_ids pattern_ids region_ids
    stop_ids _endpoint _source_file partition_date ingested_at
""".split()
STOP_COLUMNS = """
    stop_id stop_code stop_name stop_short_name tts_stop_name parent_station platform_code
    location_type stop_latitude stop_longitude region_id region_name district_id
    district_name municipality_id municipality_name parish_id parish_name locality_id
    locality jurisdiction areas wheelchair_boarding has_sidewalk sidewalk_type has_crossing
    has_flat_access has_wide_access has_tactile_access has_abusive_parking
    last_accessibility_maintenance last_accessibility_check has_pole has_cover has_shelter
    shelter_code shelter_maintainer has_mupi has_bench has_trash_bin has_lighting
    has_electricity docking_bay_type last_infrastructure_maintenance
    last_infrastructure_check has_flag flag_maintainer has_pip_static has_pip_audio
    pip_audio_code has_pip_realtime pip_realtime_code has_h2oa_signage has_schedules
    has_tactile_schedules has_network_map last_schedules_maintenance last_schedules_check
    near_health_clinic near_hospital near_university near_school near_police_station
    near_fire_station near_shopping near_historic_building near_transit_office near_beach
    subway light_rail train boat airport bike_sharing bike_parking car_parking line_ids
    pattern_ids route_ids facilities stop_url operational_status _endpoint _source_file
    partition_date ingested_at
""".split()
STOP_SENTINEL_COLUMNS = """
    locality_id locality has_sidewalk has_crossing has_flat_access has_wide_access
    has_tactile_access has_abusive_parking has_pole has_cover has_shelter shelter_code
    shelter_maintainer has_mupi has_bench has_trash_bin has_lighting has_electricity
    docking_bay_type has_flag has_pip_static has_pip_audio has_pip_realtime
    has_h2oa_signage has_schedules has_tactile_schedules has_network_map
""".split()
TRIP_COLUMNS = """
    trip_id direction_id route_id pattern_id service_id shape_id calendar_desc trip_headsign
    _source_file partition_date ingested_at
""".split()
DATE_COLUMNS = "date day_type holiday notes period _source_file partition_date ingested_at".split()


#: The newest day, where it is known; see `latest_partition`.
Day = dt.date | None


def stg_calendar_service(calendar_dates: DataFrame, anchor: DataFrame | None = None, day: Day = None) -> DataFrame:
    latest = latest_partition(calendar_dates, anchor, day)
    return latest.select(parse_gtfs_date(F.col("date")).alias("service_date"), "*")


def stg_dates(dates: DataFrame, anchor: DataFrame | None = None, day: Day = None) -> DataFrame:
    latest = normalise_sentinels(latest_partition(dates, anchor, day), ["notes"], NAN_SENTINEL)
    return latest.select(parse_gtfs_date(F.col("date")).alias("day_date"), *DATE_COLUMNS)


def stg_municipalities(municipalities: DataFrame, anchor: DataFrame | None = None, day: Day = None) -> DataFrame:
    return latest_partition(municipalities, anchor, day)


def stg_periods(periods: DataFrame, anchor: DataFrame | None = None, day: Day = None) -> DataFrame:
    return latest_partition(periods, anchor, day)


def stg_routes(routes_converted: DataFrame, anchor: DataFrame | None = None, day: Day = None) -> DataFrame:
    return latest_partition(routes_converted, anchor, day).select(ROUTE_COLUMNS)


def stg_shapes(shapes: DataFrame, anchor: DataFrame | None = None, day: Day = None) -> DataFrame:
    return latest_partition(shapes, anchor, day)


def stg_stop_times(stop_times: DataFrame, anchor: DataFrame | None = None, day: Day = None) -> DataFrame:
    return latest_partition(stop_times, anchor, day)


def stg_stops(stops_converted: DataFrame, anchor: DataFrame | None = None, day: Day = None) -> DataFrame:
    latest = latest_partition(stops_converted, anchor, day).select(STOP_COLUMNS)
    return normalise_sentinels(latest, STOP_SENTINEL_COLUMNS, STOP_SENTINELS)


def stg_trips(trips: DataFrame, anchor: DataFrame | None = None, day: Day = None) -> DataFrame:
    latest = latest_partition(trips, anchor, day).select(TRIP_COLUMNS)
    return normalise_sentinels(latest, ["calendar_desc"], NAN_SENTINEL)


# View name -> (staged table it reads, how).
VIEWS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "stg_calendar_service": ("calendar_dates", stg_calendar_service),
    "stg_dates": ("dates", stg_dates),
    "stg_municipalities": ("municipalities", stg_municipalities),
    "stg_periods": ("periods", stg_periods),
    "stg_routes": ("routes_converted", stg_routes),
    "stg_shapes": ("shapes", stg_shapes),
    "stg_stop_times": ("stop_times", stg_stop_times),
    "stg_stops": ("stops_converted", stg_stops),
    "stg_trips": ("trips", stg_trips),
}

# Views that historically took the latest day from another staged table.
CROSS_ANCHORS = {"stg_periods": "municipalities", "stg_trips": "stop_times"}
