"""Two daily runs over landed files, end to end."""

import csv
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from headway.plans import analyses, daily
from headway.plans.staging_views import CROSS_ANCHORS
from headway.schemas import feed_schema
from headway.sources.staging import convert_staged, merge_staged, read_staged, stage_all

FIRST, SECOND = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def land_json(folder, entity, rows):
    folder.mkdir(parents=True, exist_ok=True)
    full = [{c: r.get(c) for c in feed_schema(entity if entity == "lines" else f"endpoint_{entity}").fieldNames()} for r in rows]
    (folder / entity).write_text(json.dumps({"data": full} if entity == "lines" else full))


def land_text(folder, member, rows):
    (folder / "gtfs").mkdir(parents=True, exist_ok=True)
    names = list(rows[0])
    with open(folder / "gtfs" / f"{member}.txt", "w", newline="") as f:
        writer = csv.DictWriter(f, names)
        writer.writeheader()
        writer.writerows(rows)


def land_day(folder, renamed):
    ids = ["a", "b"]
    land_json(folder, "lines", [{"id": "L1", "municipality_ids": ids}])
    land_json(
        folder, "routes",
        [{"id": "R1", "line_id": "L1", "tts_name": "one", "stop_ids": ["1", "2"], "locality_ids": [], "pattern_ids": ids, "region_ids": ids},
         {"id": "R9", "line_id": "L9"}],
    )
    land_json(
        folder, "stops",
        [{"id": "000001", "municipality_id": "5", "region_id": "X", "line_ids": ["L1"], "wheelchair_boarding": True, "locality_id": None},
         {"id": "000002", "municipality_id": "5", "region_id": "X", "line_ids": None}],
    )
    land_text(
        folder, "routes",
        [{"route_id": "R1", "route_long_name": "Route one", "route_short_name": "1", "line_id": 1,
          "line_long_name": "Line one", "line_short_name": "L1", "school": "", "route_type": 3, "circular": 0}],
    )
    land_text(
        folder, "stops",
        [{"stop_id": 1, "stop_name": renamed, "stop_lat": 38.5, "stop_lon": -9.1, "municipality_name": "M",
          "region_name": "RX", "near_school": 1, "has_pole": "NaN", "stop_code": 1},
         {"stop_id": 2, "stop_name": "Two", "stop_lat": "", "stop_lon": -9.2, "municipality_name": "M",
          "region_name": "RX", "near_school": 0, "has_pole": "yes", "stop_code": 2}],
    )
    land_text(
        folder, "trips",
        [{"trip_id": f"t{i}", "route_id": "R1", "service_id": "S1", "pattern_id": "P", "shape_id": "SH",
          "direction_id": 0, "trip_headsign": "Centre", "calendar_desc": "" if i else "Weekdays"} for i in range(3)],
    )
    land_text(
        folder, "stop_times",
        [{"trip_id": f"t{i}", "stop_id": s, "stop_sequence": s, "arrival_time": f"{7 + 9 * i:02}:{s}0:00",
          "departure_time": f"{7 + 9 * i:02}:{s}0:30", "pickup_type": 0, "drop_off_type": 0, "timepoint": 1,
          "shape_dist_traveled": s * 1.5} for i in range(3) for s in (1, 2)],
    )
    (folder / "facilities_schools").write_text(json.dumps({"data": [{"id": "s1", "place": {"x": 1}}]}))
    land_text(folder, "agency", [{"agency_id": "A1", "agency_name": "Agency"}])
    land_text(folder, "periods", [{"period_id": 1, "period_name": "Winter"}])
    days = [{"date": 20240101 + i, "day_type": 1, "holiday": int(i == 0), "period": 1} for i in range(3)]
    land_text(folder, "dates", [d | {"notes": ""} for d in days])
    land_text(folder, "calendar_dates", [d | {"service_id": "S1", "exception_type": 1} for d in days])
    land_text(folder, "shapes", [{"shape_id": "SH", "shape_pt_lat": 38.5, "shape_pt_lon": -9.1, "shape_pt_sequence": 1, "shape_dist_traveled": 0}])
    land_text(
        folder, "municipalities",
        [{"municipality_id": 5, "municipality_name": "M", "municipality_prefix": 1, "district_id": 9,
          "district_name": "D", "region_id": "X", "region_name": "RX"}],
    )


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("daily")
    reports = []
    for date, name in ((FIRST, "One"), (SECOND, "One, renamed")):
        land_day(root / "landing" / str(date), name)
        report = daily.run(
            spark, str(root / "landing" / str(date)), str(root / "warehouse"), date,
            run_at=dt.datetime.combine(date, dt.time(4), dt.timezone.utc),
            payload_shapes={"lines": "data", "facilities_schools": "data"},
            extra_endpoints=["/facilities/schools"],
        )
        reports.append({(r.model, r.column_name, r.check_name): r.failures for r in report.collect()})
    return str(root / "warehouse"), reports


def test_checks(warehouse):
    _, reports = warehouse
    assert len(reports[1]) == 141
    assert {k for k, n in reports[1].items() if n} == set()


def test_staging_keeps_both_days_and_views_the_last(spark, warehouse):
    root, _ = warehouse
    staged = read_staged(spark, f"{root}/staging", "stops_converted")
    assert {str(r[0]) for r in staged.select("partition_date").distinct().collect()} == {str(FIRST), str(SECOND)}
    views = daily.staging_views(spark, root)
    stops = {r.stop_id: r for r in views["stg_stops"].collect()}
    assert stops[1].stop_name == "One, renamed" and stops[2].stop_latitude == 0.0
    assert (stops[1].has_pole, stops[1].has_bench, stops[1].line_ids, stops[2].line_ids) == ("N/A", "N/A", ["L1"], None)
    assert stops[1].locality_id == "N/A" and stops[1].wheelchair_boarding is True
    trips = {r.trip_id: r.calendar_desc for r in views["stg_trips"].collect()}
    assert trips == {"t0": "Weekdays", "t1": "UNKNOWN", "t2": "UNKNOWN"}
    anchored = daily.staging_views(spark, root, CROSS_ANCHORS)
    assert anchored["stg_trips"].count() == 3 and anchored["stg_periods"].count() == 1
    assert read_staged(spark, f"{root}/staging", "lines_converted").first().municipality_ids == ["a", "b"]


def test_raw_layer_has_what_staging_does_not_read(spark, warehouse):
    agency = spark.read.parquet(f"{warehouse[0]}/raw/gtfs/agency")
    assert {(r.agency_name, r._source_file) for r in agency.collect()} == {("Agency", "agency.txt")}
    schools = spark.read.parquet(f"{warehouse[0]}/raw/facilities_schools")
    assert {(r.id, r.place, r._endpoint) for r in schools.collect()} == {("s1", '{"x":1}', "/facilities/schools")}
    assert agency.count() == schools.count() == 2


def test_marts(spark, warehouse):
    marts = daily.read_marts(spark, warehouse[0])
    assert {n: df.count() for n, df in marts.items()} == {
        "dim_calendar_service": 3, "dim_line": 1, "dim_stop": 2, "dim_trip": 3,
        "fact_trip_schedule": 9, "fact_stop_event": 18,
    }
    peak = {r.is_peak: r.trip_count for r in analyses.peak_schedule(marts["fact_trip_schedule"]).collect()}
    # Trips leave at 07:10, 16:10 and 25:10; the first day is a holiday.
    assert peak == {True: 2, False: 7}
    lines = analyses.which_lines_for_each_stop(marts["fact_stop_event"]).first()
    assert lines.lines_with_details == "L1 (Line one)"


def test_facts_are_partitioned_by_date(spark, warehouse):
    fact = spark.read.parquet(f"{warehouse[0]}/marts/fact_stop_event").where("stop_event_date = '2024-01-02'")
    assert fact.count() == 6
    assert "PartitionFilters: [isnotnull(stop_event_date" in fact._jdf.queryExecution().executedPlan().toString()


def test_history_has_the_rename(spark, warehouse):
    history = daily.read_snapshots(spark, warehouse[0])
    names = [
        (r.stop_name, r.dbt_valid_from.day, r.dbt_valid_to and r.dbt_valid_to.day)
        for r in history["snapshot_dim_stop"].where("stop_id = 1").orderBy("dbt_valid_from").collect()
    ]
    assert names == [("One", 1, 2), ("One, renamed", 2, None)]
    assert history["snapshot_dim_trip"].count() == 3 and history["snapshot_dim_line"].count() == 1


def test_full_refresh_gives_the_same_marts(spark, warehouse, tmp_path):
    root = warehouse[0]
    stamp = F.to_timestamp(F.lit("2024-01-02 04:00:00"))
    fresh = str(tmp_path)
    stage_all(spark, f"{root}/raw", f"{fresh}/staging", stamp)
    for entity in ("routes", "stops"):
        merge_staged(spark, f"{fresh}/staging", entity, stamp)
    for table in ("routes", "stops", "lines"):
        convert_staged(spark, f"{fresh}/staging", table)
    old, new = daily.staging_views(spark, root), daily.staging_views(spark, fresh)
    for name in old:
        a, b = old[name].drop("ingested_at"), new[name].drop("ingested_at")
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, name


def test_catalog_answers_sql(spark, warehouse):
    names = daily.open_catalog(spark, warehouse[0])
    assert len(names) == 27
    answer = spark.sql("select count(*) n from fact_stop_event e join dim_stop s on e.stop_id = s.stop_id")
    assert answer.first().n == 18
