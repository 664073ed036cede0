import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.catalogue.inputs import Inputs
from headway.plans.dimensions import dim_stop
from headway.plans.facts import (
    fact_stop_event,
    fact_trip_schedule,
    stops_enriched,
    trip_peak_analysis,
    trip_summary,
)

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(
        [(t, "R1", "P", "SH", "S1" if t != "t4" else "S2", 0, "Centre") for t in ("t1", "t2", "t3", "t4")],
        "trip_id string, route_id string, pattern_id string, shape_id string, service_id string, "
        "direction_id bigint, trip_headsign string",
    )


@pytest.fixture
def stop_times(spark):
    return spark.createDataFrame(
        [
            ("t1", 1, 1, "07:00:00", "07:00:30", 0.0),
            ("t1", 2, 2, "07:30:00", "07:31:00", 4.126),
            ("t2", 1, 1, "23:50:00", "23:50:00", 0.0),
            ("t2", 2, 2, "25:10:00", "25:10:00", 3.0),
            ("t4", 3, 1, "08:00:00", "08:00:00", None),
        ],
        "trip_id string, stop_id bigint, stop_sequence bigint, arrival_time string, "
        "departure_time string, shape_dist_traveled double",
    ).withColumns({"pickup_type": F.lit(0).cast("bigint"), "drop_off_type": F.lit(0).cast("bigint")})


@pytest.fixture
def calendar(spark):
    return spark.createDataFrame(
        [
            ("S1", D1, 20240101, 1, 1, 0, 1),
            ("S1", D2, 20240102, 1, 2, 0, 1),
        ],
        "service_id string, service_date date, date bigint, day_type bigint, exception_type bigint, "
        "holiday bigint, period bigint",
    )


def test_trip_schedule(trips, stop_times, calendar):
    rows = {
        (r.trip_id, r.trip_date): r for r in fact_trip_schedule(trips, stop_times, calendar).collect()
    }
    # t4 runs on a service without days; t3 has no stop times.
    assert set(rows) == {(t, d) for t in ("t1", "t2", "t3") for d in (D1, D2)}
    first = rows["t1", D1]
    assert (first.departure_time, first.arrival_time) == (25230, 27000)
    assert (first.duration_minutes, first.distance_km, first.total_stops) == (30.0, 4.13, 2)
    assert first.is_peak and not rows["t1", D2].is_peak
    lone = rows["t3", D1]
    assert (lone.departure_time, lone.duration_minutes, lone.total_stops) == (None, None, None)
    assert (lone.distance_km, lone.is_peak) == (0.0, False)


def test_clock_of_a_trip_past_midnight(trips, stop_times, calendar):
    wrapped = trip_summary(stop_times).where("trip_id = 't2'").first()
    assert (wrapped.departure_time_begin, wrapped.arrival_time_end) == (4200, 85800)
    in_order = trip_summary(stop_times, clock="sequence").where("trip_id = 't2'").first()
    assert (in_order.departure_time_begin, in_order.arrival_time_end) == (85800, 4200)
    assert wrapped.duration_minutes == in_order.duration_minutes == 80.0
    with pytest.raises(ValueError):
        trip_summary(stop_times, clock="lunar")


def test_active_only_drops_removed_days(trips, stop_times, calendar):
    active = fact_trip_schedule(trips, stop_times, calendar, active_only=True)
    assert {r.trip_date for r in active.collect()} == {D1}


def test_two_calendar_rows_of_a_day_are_not_squared(trips, stop_times, calendar):
    twice = calendar.unionByName(
        calendar.where(F.col("service_date") == D1).withColumn("holiday", F.lit(1).cast("bigint"))
    )
    fact = fact_trip_schedule(trips, stop_times, twice).where("trip_id = 't1'")
    assert fact.where(F.col("trip_date") == D1).count() == 2
    assert sorted(r.is_peak for r in fact.where(F.col("trip_date") == D1).collect()) == [False, True]


def test_peak_analysis_agrees_with_the_fact(spark, sf_dir):
    src = Inputs(spark, sf_dir)
    fact = fact_trip_schedule(src("trips"), src("stop_times"), src("calendar"))
    peak = trip_peak_analysis(src("stop_times"), src("trips"), src("calendar"))
    both = fact.join(
        peak.select("trip_id", F.col("service_date").alias("trip_date"), F.col("is_peak").alias("p")),
        ["trip_id", "trip_date"],
    )
    assert both.count() == peak.count() > 0
    assert both.where("p <> is_peak").count() == 0


def test_one_row_per_trip_and_day(spark, sf_dir):
    src = Inputs(spark, sf_dir)
    fact = fact_trip_schedule(src("trips"), src("stop_times"), src("calendar"))
    expected = src("trips").join(src("calendar"), "service_id").count()
    assert fact.count() == expected
    assert fact.select("trip_key").distinct().count() == expected


def test_stop_events_are_stops_times_days(spark, sf_dir):
    src = Inputs(spark, sf_dir)
    events = fact_stop_event(
        *map(src, ("stop_times", "trips", "routes", "calendar", "stops", "municipalities"))
    )
    per_trip = src("stop_times").join(
        stops_enriched(src("stops"), src("municipalities")).select("stop_id"), "stop_id"
    ).groupBy("trip_id").agg(F.count("*").alias("stops"))
    days = src("calendar").groupBy("service_id").agg(F.count("*").alias("days"))
    expected = (
        src("trips").join(per_trip, "trip_id").join(days, "service_id").agg(F.sum(F.col("stops") * F.col("days")))
    ).first()[0]
    assert events.count() == expected > 0


def test_active_stop_events(spark, sf_dir):
    src = Inputs(spark, sf_dir)
    inputs = [src(n) for n in ("stop_times", "trips", "routes", "calendar", "stops", "municipalities")]
    active = [df if i != 3 else df.where("exception_type = 1") for i, df in enumerate(inputs)]
    assert fact_stop_event(*inputs, active_only=True).count() == fact_stop_event(*active).count()
    assert fact_stop_event(*active).count() < fact_stop_event(*inputs).count()


def test_stop_without_numeric_municipality_drops_out(spark):
    stops = spark.createDataFrame(
        [(1, "a", "5"), (2, "b", "UNKNOWN"), (3, "c", None), (4, "d", "05")],
        "stop_id bigint, stop_name string, municipality_id string",
    ).withColumns(
        {c: F.lit("x") for c in ("municipality_name", "region_id", "region_name")}
        | {"near_school": F.lit(None).cast("bigint")}
    )
    municipalities = spark.createDataFrame(
        [(5, 50, "D")], "municipality_id bigint, district_id bigint, district_name string"
    )
    got = stops_enriched(stops, municipalities)
    assert sorted((r.stop_id, r.municipality_id, r.district_id) for r in got.collect()) == [
        (1, "5", 50), (4, "05", 50),
    ]


def test_dim_stop_picks_the_earliest_row(spark):
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [(1, "late", late), (1, "early", early), (2, "b", early), (2, "a", early), (2, None, early)]
    df = spark.createDataFrame(rows, "stop_id bigint, stop_name string, ingested_at timestamp").withColumns(
        {"stop_latitude": F.lit(0.0), "stop_longitude": F.lit(0.0), "near_school": F.lit(0)}
        | {c: F.lit("x") for c in ("municipality_id", "municipality_name", "region_id", "region_name")}
    )
    assert {r.stop_id: r.stop_name for r in dim_stop(df).collect()} == {1: "early", 2: None}


def test_stop_events_are_shuffled_by_trip_once_they_lie_by_stop(spark, sf_dir):
    src = Inputs(spark, sf_dir)
    names = ("stop_times", "trips", "routes", "calendar", "stops", "municipalities")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for most in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        try:
            plan = fact_stop_event(*map(src, names))._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        # Outermost first: the trips are joined above the stops, which are merged with rows shuffled by stop.
        assert plan.index("Join [trip_id") < plan.index("SortMergeJoin [stop_id")
