"""Each analysis gives the same over its fact and over its roll-up."""

import pytest
from pyspark.sql import functions as F

from headway.catalogue.inputs import Inputs
from headway.catalogue.queries import LINE_ID
from headway.plans import analyses, facts, rollups

FACT_INPUTS = ("stop_times", "trips", "routes", "calendar", "stops", "municipalities")


@pytest.fixture(scope="module")
def src(spark, sf_dir):
    return Inputs(spark, sf_dir)


@pytest.fixture(scope="module")
def schedule(src):
    return facts.fact_trip_schedule(src("trips"), src("stop_times"), src("calendar"))


@pytest.fixture(scope="module")
def events(src):
    return facts.fact_stop_event(*map(src, FACT_INPUTS))


def same(left, right):
    a, b = [tuple(r) for r in left.collect()], [tuple(r) for r in right.collect()]
    assert left.columns == right.columns
    assert a == b and a


def test_avgtime_trip(src, schedule):
    rolled = rollups.trip_durations(src("trips"), src("stop_times"), src("calendar"))
    same(analyses.avgtime_trip(schedule), analyses.avgtime_trip(rolled, rollups.TRIP_COUNT))


def test_avgtime_of_nothing_and_of_one(spark):
    one = spark.createDataFrame([(5.0, 1)], "duration_minutes double, trip_count bigint")
    assert tuple(analyses.avgtime_trip(one, "trip_count").first()) == (5.0, 5.0, 5.0, None, 1)
    assert tuple(analyses.avgtime_trip(one).first()) == (5.0, 5.0, 5.0, None, 1)
    none = one.where("false")
    assert tuple(analyses.avgtime_trip(none, "trip_count").first()) == (None, None, None, None, 0)
    assert tuple(analyses.avgtime_trip(none).first()) == (None, None, None, None, 0)


def test_weighted_deviation_does_not_cancel(spark):
    wide = spark.createDataFrame(
        [(1_000_000.0, 10**12), (1_000_001.0, 10**12)], "duration_minutes double, trip_count bigint"
    )
    row = analyses.avgtime_trip(wide, "trip_count").first()
    assert (row[0], row[3], row[4]) == (1_000_000.5, 0.5, 2 * 10**12)


def test_trips_by_date(src, schedule):
    rolled = rollups.trips_per_day(src("trips"), src("calendar"))
    same(analyses.trips_by_date(schedule), analyses.trips_by_date(rolled, rollups.TRIP_COUNT))


def test_peak_schedule(src, schedule):
    rolled = rollups.trips_by_peak(src("trips"), src("stop_times"), src("calendar"))
    same(analyses.peak_schedule(schedule), analyses.peak_schedule(rolled, rollups.TRIP_COUNT))


@pytest.mark.parametrize("name", ["daily_line_frequency", "stops_near_school"])
def test_counts_per_day(src, events, name):
    rolled = rollups.stop_events_per_day(*map(src, FACT_INPUTS))
    ask = getattr(analyses, name)
    same(ask(events), ask(rolled, rollups.STOP_EVENT_COUNT))


@pytest.mark.parametrize("name", ["top10_lines_for_stop", "which_lines_for_each_stop"])
def test_lines_of_stops(src, events, name):
    ask = getattr(analyses, name)
    same(ask(events), ask(rollups.lines_per_stop(*map(src, FACT_INPUTS))))


@pytest.mark.parametrize("name", ["stops_by_municipality", "stops_by_region"])
@pytest.mark.parametrize("rollup", [rollups.stops_served, rollups.lines_per_stop])
def test_stops_of_areas(src, events, name, rollup):
    ask = getattr(analyses, name)
    same(ask(events), ask(rollup(*map(src, FACT_INPUTS))))


def test_line_frequency(src, events):
    same(
        analyses.line_frequency(events, LINE_ID),
        rollups.line_frequency_at_stops(*map(src, FACT_INPUTS), LINE_ID),
    )


def test_line_frequency_with_repeated_trips(src):
    """A trip listed under two services is still one trip."""
    trips = src("trips")
    doubled = trips.unionByName(trips.withColumn("service_id", F.lit("S1")))
    inputs = [src(n) if n != "trips" else doubled for n in FACT_INPUTS]
    same(
        analyses.line_frequency(facts.fact_stop_event(*inputs), LINE_ID),
        rollups.line_frequency_at_stops(*inputs, LINE_ID),
    )


def test_shares_add_up(events, schedule):
    for answer in (
        analyses.stops_by_municipality(events),
        analyses.stops_by_region(events),
        analyses.peak_schedule(schedule),
    ):
        rows = answer.collect()
        assert abs(sum(r.percentage_of_total for r in rows) - 100) <= 0.005 * len(rows) + 1e-9


def test_distance_trip_is_ordered(schedule):
    rows = analyses.distance_trip(schedule).collect()
    keys = [(-r.total_distance_km, r.trip_id, r.trip_date) for r in rows]
    assert keys == sorted(keys) and all(r.total_distance_km > 0 for r in rows)
