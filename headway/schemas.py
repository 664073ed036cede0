"""Column names and types of the landed tables and of the contracted marts."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

# The column layout of the feed, one table per name. Endpoint
# tables come from the JSON API, the others from the GTFS text files. The
# *_ids and facilities columns of endpoint tables hold JSON arrays as text.
FEED_COLUMNS = {
    "lines": """
        color string, district_ids string, facilities string, id string, locality_ids string,
        long_name string, municipality_ids string, pattern_ids string, region_ids string,
        route_ids string, short_name string, stop_ids string, text_color string, tts_name string""",
    "endpoint_routes": """
        color string, district_ids string, facilities string, id string, line_id string,
        locality_ids string, long_name string, municipality_ids string, pattern_ids string,
        region_ids string, short_name string, stop_ids string, text_color string, tts_name string""",
    "gtfs_routes": """
        agency_id string, circular bigint, line_id bigint, line_long_name string,
        line_short_name string, line_type double, path_type bigint, route_color string,
        route_id string, route_long_name string, route_short_name string,
        route_text_color string, route_type bigint, school double""",
    "endpoint_stops": """
        district_id string, facilities string, id string, lat double, line_ids string,
        locality_id string, lon double, long_name string, municipality_id string,
        operational_status string, pattern_ids string, region_id string, route_ids string,
        short_name string, tts_name string, wheelchair_boarding boolean""",
    "gtfs_stops": """
        stop_id bigint, stop_name string, stop_name_new string, stop_short_name string,
        stop_lat double, stop_lon double, operational_status string, areas string,
        region_id string, region_name string, district_id bigint, district_name string,
        municipality_id bigint, municipality_name string, parish_id double, parish_name double,
        locality string, jurisdiction double, stop_code bigint, tts_stop_name string,
        platform_code double, parent_station double, location_type bigint, stop_url string,
        has_pole string, has_cover string, has_shelter string, shelter_code string,
        shelter_maintainer string, has_mupi string, has_bench string, has_trash_bin string,
        has_lighting string, has_electricity string, docking_bay_type string,
        last_infrastructure_maintenance double, last_infrastructure_check double,
        has_flag string, flag_maintainer double, has_pip_static string, has_pip_audio string,
        pip_audio_code double, has_pip_realtime string, pip_realtime_code double,
        has_h2oa_signage string, has_schedules string, has_tactile_schedules string,
        has_network_map string, last_schedules_maintenance double, last_schedules_check double,
        has_sidewalk string, sidewalk_type double, has_crossing string, has_flat_access string,
        has_wide_access string, has_tactile_access string, has_abusive_parking string,
        wheelchair_boarding bigint, last_accessibility_maintenance double,
        last_accessibility_check double, near_health_clinic bigint, near_hospital bigint,
        near_university bigint, near_school bigint, near_police_station bigint,
        near_fire_station bigint, near_shopping bigint, near_historic_building bigint,
        near_transit_office bigint, near_beach bigint, subway bigint, light_rail bigint,
        train bigint, boat bigint, airport bigint, bike_sharing bigint, bike_parking bigint,
        car_parking bigint""",
    "stop_times": """
        arrival_time string, departure_time string, drop_off_type bigint, pickup_type bigint,
        shape_dist_traveled double, stop_id bigint, stop_sequence bigint, timepoint bigint,
        trip_id string""",
    "trips": """
        calendar_desc string, direction_id bigint, pattern_id string, route_id string,
        service_id string, shape_id string, trip_headsign string, trip_id string""",
    "periods": "period_id bigint, period_name string",
    "dates": "date bigint, day_type bigint, holiday bigint, notes string, period bigint",
    "calendar_dates": """
        date bigint, day_type bigint, exception_type bigint, holiday bigint, period bigint,
        service_id string""",
    "shapes": """
        shape_dist_traveled double, shape_id string, shape_pt_lat double, shape_pt_lon double,
        shape_pt_sequence bigint""",
    "municipalities": """
        district_id bigint, district_name string, municipality_id bigint,
        municipality_name string, municipality_prefix bigint, region_id string,
        region_name string""",
}

ENDPOINT_TABLES = ("lines", "endpoint_routes", "endpoint_stops")
ENDPOINT_LINEAGE = "_endpoint"
FILE_LINEAGE = "_source_file"
PARTITION_COLUMN = "partition_date"
INGESTED_AT = "ingested_at"


TYPES = {
    "string": StringType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
}


def columns(text: str) -> StructType:
    """`name type, name type, ...` as a schema; unlike a DDL parse it needs no session."""
    schema = StructType()
    for column in text.split(","):
        name, kind = column.split()
        schema.add(name, TYPES[kind])
    return schema


def lineage_column(table: str) -> str:
    return ENDPOINT_LINEAGE if table in ENDPOINT_TABLES else FILE_LINEAGE


def feed_schema(table: str) -> StructType:
    """The columns the feed itself delivers for `table`."""
    return columns(FEED_COLUMNS[table])


def raw_schema(table: str) -> StructType:
    """Schema of the raw layer: the feed's columns, lineage, and the extraction day as text."""
    return feed_schema(table).add(lineage_column(table), StringType()).add(PARTITION_COLUMN, StringType())


def staged_schema(table: str) -> StructType:
    """Schema after staging: the extraction day is a date and the load time is stamped."""
    return (
        feed_schema(table)
        .add(lineage_column(table), StringType())
        .add(INGESTED_AT, TimestampType())
        .add(PARTITION_COLUMN, DateType())
    )
