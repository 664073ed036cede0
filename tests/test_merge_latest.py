import datetime as dt

from headway.operators.latest import latest_partition
from headway.operators.merge import MERGES, MergeSpec, merge_sources
from headway.plans.staging_views import STOP_COLUMNS, STOP_SENTINEL_COLUMNS, ROUTE_COLUMNS

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
SPEC = MergeSpec("stops", "stop_id", exclude=("id", "lat"), rename={"stop_lat": "stop_latitude"})


def sources(spark):
    endpoint = spark.createDataFrame(
        [
            ("010101", 1.0, "e1", D1),
            ("010101", 1.0, "e1", D1),
            ("010101", 1.0, "e1", D2),
            ("x", 2.0, "e2", D1),
            ("7", 2.0, "e3", D1),
        ],
        "id string, lat double, municipality_id string, partition_date date",
    )
    feed = spark.createDataFrame(
        [
            (10101, 5.0, 99, "name", D1),
            (10101, 5.0, 99, "name", D1),
            (10101, 5.0, 99, "new name", D2),
            (8, 5.0, 99, "other", D1),
        ],
        "stop_id bigint, stop_lat double, municipality_id bigint, stop_name string, partition_date date",
    )
    return endpoint, feed


def test_merge_matches_days_and_leading_zeros(spark):
    merged = merge_sources(*sources(spark), SPEC)
    assert merged.columns == ["municipality_id", "partition_date", "stop_id", "stop_latitude", "stop_name"]
    assert merged.schema["municipality_id"].dataType.simpleString() == "string"
    assert sorted(map(tuple, merged.collect())) == [
        ("e1", D1, 10101, 5.0, "name"),
        ("e1", D2, 10101, 5.0, "new name"),
    ]


def test_merge_over_all_days_multiplies_changed_rows(spark):
    rows = sorted(map(tuple, merge_sources(*sources(spark), SPEC, match_partition=False).collect()))
    assert rows == [
        ("e1", D1, 10101, 5.0, "name"),
        ("e1", D1, 10101, 5.0, "new name"),
        ("e1", D2, 10101, 5.0, "name"),
        ("e1", D2, 10101, 5.0, "new name"),
    ]


def test_removing_copies_first_equals_removing_them_last(spark):
    endpoint, feed = sources(spark)
    ours = merge_sources(endpoint, feed, SPEC, match_partition=False)
    added = feed.select("stop_id", "stop_lat", "stop_name")
    literal = (
        endpoint.join(added, endpoint.id.try_cast("bigint") == added.stop_id)
        .dropDuplicates()
        .drop("id", "lat")
        .withColumnRenamed("stop_lat", "stop_latitude")
    )
    assert ours.exceptAll(literal).count() == literal.exceptAll(ours).count() == 0


def test_merged_tables():
    assert MERGES["routes"].feed_key == "route_id" and len(MERGES["routes"].exclude) == 5
    assert MERGES["stops"].feed_key == "stop_id" and len(MERGES["stops"].exclude) == 7


def test_view_columns():
    assert len(STOP_COLUMNS) == len(set(STOP_COLUMNS)) == 86
    assert len(ROUTE_COLUMNS) == len(set(ROUTE_COLUMNS)) == 26
    assert len(STOP_SENTINEL_COLUMNS) == 27 and set(STOP_SENTINEL_COLUMNS) < set(STOP_COLUMNS)


def test_latest_partition_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, D1), (2, D2), (3, D2)], "id int, partition_date date")
    df.write.partitionBy("partition_date").parquet(path)
    latest = latest_partition(spark.read.parquet(path))
    assert sorted(r.id for r in latest.collect()) == [2, 3]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "Subquery" in line)
    assert "PartitionFilters: [isnotnull(partition_date" in scan and "= Subquery" in scan
    literal = latest_partition(spark.read.parquet(path), day=D1)
    assert [r.id for r in literal.collect()] == [1]


def test_latest_partition_of_an_anchor(spark):
    df = spark.createDataFrame([(1, D1), (2, D2)], "id int, partition_date date")
    anchor = spark.createDataFrame([(D1,)], "partition_date date")
    assert [r.id for r in latest_partition(df, anchor).collect()] == [1]
    nothing = anchor.where("false")
    assert latest_partition(df, nothing).count() == 0
