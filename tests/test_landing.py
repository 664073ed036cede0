import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from headway.schemas import columns, feed_schema, raw_schema
from headway.session import scratch_dir
from headway.operators.latest import latest_partition, newest_day
from headway.sources.landing import land, landed_endpoints, read_gtfs_text, read_json_payload
from headway.sources.staging import ENTITIES, ARRAY_COLUMNS, stage_table, staged_tables
from headway.sources.tables import (
    entity_name,
    raw_path,
    read_with_schema,
    replace_partitions,
    replace_table,
)
from headway.sources.versions import read_days

ROWS = [
    {"id": "1", "long_name": "Évora", "municipality_ids": ["11", "12"], "facilities": []},
    {"id": "2", "long_name": None, "municipality_ids": None, "facilities": [{"kind": "é"}]},
]


def write(path, document):
    path.write_text(json.dumps(document, ensure_ascii=False), encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("shape,wrap", [("records", lambda r: r), ("data", lambda r: {"data": r, "n": 2})])
def test_json_lists(spark, tmp_path, shape, wrap):
    path = write(tmp_path / "lines.json", wrap(ROWS))
    df = read_json_payload(spark, path, "/lines", feed_schema("lines"), shape)
    rows = {r.id: r for r in df.collect()}
    assert json.loads(rows["1"].municipality_ids) == ["11", "12"]
    assert (rows["1"].long_name, rows["1"].facilities, rows["2"].municipality_ids) == ("Évora", "[]", None)
    assert json.loads(rows["2"].facilities) == [{"kind": "é"}] and "é" in rows["2"].facilities
    assert {r._endpoint for r in rows.values()} == {"/lines"}
    assert df.columns == [*feed_schema("lines").fieldNames(), "_endpoint"]


def test_json_object_is_flattened(spark, tmp_path):
    path = write(tmp_path / "f.json", {"available": ["a", "b"], "meta": {"v": 1, "by": {"who": "x"}}})
    row = read_json_payload(spark, path, "/facilities", shape="object").first().asDict()
    assert json.loads(row.pop("available")) == ["a", "b"]
    assert row == {"meta.v": 1, "meta.by.who": "x", "_endpoint": "/facilities"}


def test_json_without_schema_is_inferred(spark, tmp_path):
    path = write(tmp_path / "f.json", {"data": ROWS})
    df = read_json_payload(spark, path, "/x", shape="data")
    assert {json.loads(r.facilities)[0]["kind"] for r in df.where("id = '2'").collect()} == {"é"}
    with pytest.raises(ValueError):
        read_json_payload(spark, path, "/x", shape="table")


def test_gtfs_text_is_matched_by_name(spark, tmp_path):
    path = tmp_path / "stops.txt"
    path.write_text("stop_name,surplus,stop_id,near_school,stop_lat\n\"A, b\",x,7,1.0,38.5\nC,y,bad,,\n")
    df = read_gtfs_text(spark, str(path), columns("stop_id bigint, stop_lat double, stop_name string, near_school bigint, absent double"))
    assert [tuple(r) for r in df.collect()] == [
        (7, 38.5, "A, b", 1, None, "stops.txt"),
        (None, None, "C", None, None, "stops.txt"),
    ]
    assert read_gtfs_text(spark, str(path)).columns == [
        "stop_name", "surplus", "stop_id", "near_school", "stop_lat", "_source_file",
    ]


def test_gtfs_files_with_other_headers_stop_the_read(spark, tmp_path):
    folder = tmp_path / "trips.txt"
    folder.mkdir()
    (folder / "a.txt").write_text("trip_id,route_id\n1,2\n")
    (folder / "b.txt").write_text("route_id,trip_id\n3,4\n")
    with pytest.raises(Exception, match="header"):
        read_gtfs_text(spark, str(folder), columns("trip_id string, route_id string")).collect()


def test_landing_a_day_again_keeps_other_days(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("1",), ("2",)], "trip_id string")
    land(df, root, "gtfs", "trips", "20240101")
    land(df, root, "gtfs", "trips", "20240102")
    path = land(df.limit(1), root, "gtfs", "trips", "20240102")
    counts = read_with_schema(spark, path, raw_schema("trips")).groupBy("partition_date").count()
    assert {tuple(r) for r in counts.collect()} == {("20240101", 2), ("20240102", 1)}


def test_full_refresh_drops_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, partition_date string")
    replace_partitions(df, path)
    replace_table(df.where("id = '2'"), path, "partition_date")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("2", "b")]


def test_declared_schema_wins_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "20240101")], "trip_id string, partition_date string").write.partitionBy(
        "partition_date"
    ).parquet(path)
    row = read_with_schema(spark, path, raw_schema("trips")).first()
    assert (row.trip_id, row.partition_date, row.direction_id) == ("1", "20240101", None)


def test_a_broken_document_stops_the_read(spark, tmp_path):
    for i, (shape, text) in enumerate(
        [("records", '[{"id": "1"}, {"id": "2"'), ("data", '{"data": [{"id": "1"}'), ("data", '{"n": 1}')]
    ):
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="data|FAILFAST|MALFORMED|Malformed"):
            read_json_payload(spark, str(path), "/x", columns("id string"), shape).collect()


def test_standard_quoting(spark, tmp_path):
    path = tmp_path / "stops.txt"
    path.write_text('stop_id,stop_name,stop_url\n1,"Rua ""A"", Lisboa",u1\n2,"two\nlines",u2\n3,plain,u3\n')
    schema = columns("stop_id bigint, stop_name string, stop_url string")
    rows = read_gtfs_text(spark, str(path), schema, multi_line=True).collect()
    # Rows of a table have no order.
    assert sorted(tuple(r)[:3] for r in rows) == [
        (1, 'Rua "A", Lisboa', "u1"), (2, "two\nlines", "u2"), (3, "plain", "u3"),
    ]


@pytest.mark.parametrize("row", ["1,2,3", "1"])
def test_a_ragged_row_stops_the_read(spark, tmp_path, row):
    path = tmp_path / "trips.txt"
    path.write_text(f"trip_id,route_id\na,b\n{row}\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED|Malformed"):
        read_gtfs_text(spark, str(path), columns("trip_id string")).collect()


def test_only_whole_numbers_are_integers(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("a\n5.0\n5.7\n5\nx\n1e3\n")
    got = [r.a for r in read_gtfs_text(spark, str(path), columns("a bigint")).collect()]
    assert got == [5, None, 5, None, 1000]


def test_a_day_landed_and_staged_again_without_rows_is_empty(spark, tmp_path):
    raw, incremental, fresh = str(tmp_path / "raw"), str(tmp_path / "a"), str(tmp_path / "b")
    table = next(t for t in staged_tables() if t.schema == "trips")
    df = spark.createDataFrame([("1",), ("2",)], "trip_id string")
    stamp = F.lit("2024-01-03").cast("timestamp")
    for rows in (df, df.limit(1), df.limit(0)):
        for day in ("20240101", "20240102"):
            land(rows if day == "20240102" else df, raw, "gtfs", "trips", day)
            stage_table(spark, raw, incremental, table, stamp, day)
        a = read_days(spark, stage_table(spark, raw, fresh, table, stamp))
        b = read_days(spark, f"{incremental}/staging_trips")
        assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(a.columns)).collect()))
    assert newest_day(spark, f"{incremental}/staging_trips") == dt.date(2024, 1, 1)


def test_the_latest_day_reads_no_other(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(1000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 5 as int)) partition_date")
    replace_partitions(days, path)
    view = latest_partition(spark.read.parquet(path), day=newest_day(spark, path))
    assert view.count() == 200
    view.collect()
    plan = view._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() == 200
    assert scan.metrics().apply("numPartitions").value() == 1


def test_landed_endpoints_are_found(spark, tmp_path):
    for name in ("lines", "facilities_schools", "municipalities", "_SUCCESS"):
        (tmp_path / name).write_text("[]")
    (tmp_path / "gtfs").mkdir()
    assert landed_endpoints(spark, str(tmp_path)) == ["facilities_schools", "lines", "municipalities"]


def test_names_and_paths():
    assert entity_name("/facilities/schools") == "facilities_schools"
    assert raw_path("r", "endpoint", "stops") == "r/stops"
    assert raw_path("r", "gtfs", "stops") == "r/gtfs/stops"
    with pytest.raises(ValueError):
        raw_path("r", "ftp", "stops")


def test_staged_tables():
    assert [t.schema for t in staged_tables()] == [
        "lines", "endpoint_routes", "gtfs_routes", "endpoint_stops", "gtfs_stops", "stop_times",
        "trips", "periods", "dates", "calendar_dates", "shapes", "municipalities",
    ]
    assert len(ENTITIES) == 10 and len(feed_schema("gtfs_stops")) == 78
    assert "municipality_ids" in ARRAY_COLUMNS["lines"]


def test_scratch_is_below_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(named.rstrip("/") + "/")


class Session:
    """As much of a session as the choice of a scratch folder looks at."""

    def __init__(self, master, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_without_a_named_folder_is_below_a_shared_warehouse():
    def scratch(master, warehouse):
        return scratch_dir(Session(master, **{"spark.sql.warehouse.dir": warehouse}), "x")

    assert scratch("yarn", "hdfs://c/w").startswith("hdfs://c/w/x-")
    assert scratch("local[2]", "file:/w").startswith("file:/w/x-")
    with pytest.raises(RuntimeError):
        scratch("yarn", "file:/w")
