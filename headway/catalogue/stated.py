"""What the SQL expects of the library's column lists, stated on its own.

Fixed values, so that a change of a list in the library shows as a difference.
"""

ROUTE_COLUMNS = """
    route_id route_long_name route_short_name route_type route_color route_text_color line_id
    line_long_name line_short_name line_type tts_name agency_id circular path_type school
    district_ids facilities locality_ids municipality_ids pattern_ids region_ids stop_ids _endpoint
    _source_file partition_date ingested_at
""".split()

STOP_COLUMNS = """
    stop_id stop_code stop_name stop_short_name tts_stop_name parent_station platform_code
    location_type stop_latitude stop_longitude region_id region_name district_id district_name
    municipality_id municipality_name parish_id parish_name locality_id locality jurisdiction areas
    wheelchair_boarding has_sidewalk sidewalk_type has_crossing has_flat_access has_wide_access
    has_tactile_access has_abusive_parking last_accessibility_maintenance last_accessibility_check
    has_pole has_cover has_shelter shelter_code shelter_maintainer has_mupi has_bench has_trash_bin
    has_lighting has_electricity docking_bay_type last_infrastructure_maintenance
    last_infrastructure_check has_flag flag_maintainer has_pip_static has_pip_audio pip_audio_code
    has_pip_realtime pip_realtime_code has_h2oa_signage has_schedules has_tactile_schedules
    has_network_map last_schedules_maintenance last_schedules_check near_health_clinic near_hospital
    near_university near_school near_police_station near_fire_station near_shopping
    near_historic_building near_transit_office near_beach subway light_rail train boat airport
    bike_sharing bike_parking car_parking line_ids pattern_ids route_ids facilities stop_url
    operational_status _endpoint _source_file partition_date ingested_at
""".split()

STOP_SENTINEL_COLUMNS = """
    locality_id locality has_sidewalk has_crossing has_flat_access has_wide_access
    has_tactile_access has_abusive_parking has_pole has_cover has_shelter shelter_code
    shelter_maintainer has_mupi has_bench has_trash_bin has_lighting has_electricity
    docking_bay_type has_flag has_pip_static has_pip_audio has_pip_realtime has_h2oa_signage
    has_schedules has_tactile_schedules has_network_map
""".split()

# Entity: the feed's key, the columns left out, the columns renamed.
MERGED = {
    "routes": (
        "route_id",
        "color text_color id short_name long_name".split(),
        {},
    ),
    "stops": (
        "stop_id",
        "id lat lon short_name long_name tts_name stop_name_new".split(),
        {"stop_lat": "stop_latitude", "stop_lon": "stop_longitude"},
    ),
}

ARRAYS = {
    "stops": (
        "facilities line_ids pattern_ids route_ids"
    ).split(),
    "routes": (
        "district_ids facilities locality_ids municipality_ids pattern_ids region_ids "
        "stop_ids"
    ).split(),
    "lines": (
        "district_ids facilities locality_ids municipality_ids pattern_ids region_ids "
        "route_ids stop_ids"
    ).split(),
}

# Dimension: its key and the columns whose change makes a version.
TRACKED = {
    "dim_line": (
        "route_id",
        (
            "route_long_name route_short_name route_type route_color route_text_color "
            "line_id line_long_name line_short_name line_type agency_id tts_name "
            "circular school"
        ).split(),
    ),
    "dim_stop": (
        "stop_id",
        (
            "stop_name stop_latitude stop_longitude municipality_id municipality_name "
            "region_id region_name near_school"
        ).split(),
    ),
    "dim_trip": (
        "trip_id",
        (
            "direction route_id service_id trip_headsign pattern_id shape_id"
        ).split(),
    ),
}

# Model: the columns that must not be NULL; none named stands for all.
CHECKED = {
    "stg_periods": "".split(),
    "stg_shapes": "".split(),
    "stg_municipalities": "".split(),
    "stg_calendar_service": "".split(),
    "stg_dates": "".split(),
    "stg_stop_times": "".split(),
    "stg_trips": "".split(),
    "stg_routes": "route_id line_id locality_ids pattern_ids region_ids partition_date ingested_at".split(),
    "stg_stops": "stop_id ingested_at partition_date".split(),
    "fact_trip_schedule": "".split(),
    "dim_calendar_service": "".split(),
    "dim_stop": "".split(),
    "fact_stop_event": "stop_event_key stop_event_date stop_id is_near_school ingested_at".split(),
    "dim_trip": "".split(),
    "dim_line": "route_key route_id line_id ingested_at".split(),
    "snapshot_dim_stop": "stop_id".split(),
    "snapshot_dim_line": "route_id".split(),
    "snapshot_dim_trip": "trip_id".split(),
}

# Model: the columns whose values must not repeat.
UNREPEATED = {
    "stg_trips": "trip_id".split(),
    "stg_routes": "route_id".split(),
    "fact_trip_schedule": "trip_key".split(),
    "dim_calendar_service": "calendar_service_key".split(),
    "dim_stop": "stop_key stop_id".split(),
    "fact_stop_event": "stop_event_key".split(),
    "dim_trip": "trip_key trip_id".split(),
    "dim_line": "route_key route_id".split(),
}
