"""What the physical plans must and must not hold."""

import json

import pytest
from pyspark.sql import functions as F

from headway.catalogue.inputs import Inputs
from headway.catalogue.oracles import SQL, oracle_sql
from headway.catalogue.queries import QUERIES
from headway.plans.facts import fact_trip_schedule, trips_with_dates, trips_with_routes
from headway.sources.tables import replace_partitions, replace_table

FORBIDDEN = ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition")
WRITES = {
    "read_json_payload", "read_gtfs_text", "dynamic_overwrite", "schema_on_read", "stage_table",
    "stage_all", "fact_partitioned_sink", "read_gtfs_text_quoted", "stage_table_day", "merge_staged",
    "convert_staged", "latest_partition_on_disk", "nested_endpoint",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def last_run(spark):
    """The physical plan of the last command that ran, as it ran."""
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return spark._jsparkSession.sharedState().statusStore().executionsList().last().physicalPlanDescription()


def test_multiplied_rows_are_not_sorted_before_they_are_written(spark, sf_dir, tmp_path):
    inputs = Inputs(spark, sf_dir)
    stamp = F.current_timestamp()
    fact = fact_trip_schedule(inputs("trips"), inputs("stop_times"), inputs("calendar"), run_at=stamp)
    replace_table(fact, str(tmp_path / "fact"), "trip_date", gather=False)
    final = last_run(spark).split("+- == Initial Plan ==")[0]
    assert "InsertIntoHadoopFsRelationCommand" in final
    # Outermost first: the command, what it writes, and below it the last join.
    above = final[: final.index("Join")]
    assert "Sort" not in above


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in FORBIDDEN[:-1]:
        assert node not in plan
    # One task may only combine partial aggregates: one row per task, or counts of a report.
    singles = [line for line in plan.splitlines() if FORBIDDEN[-1] in line]
    if singles and not name.startswith("dq_") and name != "avgtime_trip":
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if FORBIDDEN[-1] in line:
                assert "partial_" in lines[i + 1], lines[i + 1]


def test_hot_join_keys_are_split(spark):
    """A trip that holds a third of the stop times does not end in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        # With eight partitions the hot one is about three times the median.
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        trips = spark.range(0, 60000, 1, 8).select(
            F.col("id").cast("string").alias("trip_id"),
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("route_id"),
            F.lit("S1").alias("service_id"),
        )
        ids = spark.range(60000).select(F.col("id").cast("string").alias("route_id"))
        hot = spark.createDataFrame([("hot",)], "route_id string")
        routes = ids.unionByName(hot).withColumns(
            {c: F.lit("x") for c in ("route_long_name", "route_short_name", "line_id", "line_long_name", "line_short_name")}
            | {"school": F.lit(0.0)}
        )
        joined = trips_with_routes(trips, routes)
        assert joined.agg(F.count("*")).first()[0] == 60000
        rows = joined.collect()
        assert len(rows) == 60000
        assert "skew=true" in plan_of(joined)

        # A service that runs a third of the trips, beside a calendar too large to broadcast.
        served = trips.withColumn("service_id", F.col("route_id"))
        days = spark.range(5).select(
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("service_date"),
            F.lit(20240101).alias("date"),
            *(F.lit(1).alias(c) for c in ("day_type", "exception_type", "holiday")),
        )
        services = ids.unionByName(hot).withColumnRenamed("route_id", "service_id")
        calendar = services.crossJoin(days)
        on_days = trips_with_dates(served, calendar)
        assert on_days.count() == 5 * 60000
        on_days.collect()
        assert "skew=true" in plan_of(on_days)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    """A day that holds most rows is written as several files, a small day as one."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(0, 200000, 1, 8).select(
            F.md5(F.col("id").cast("string")).alias("key"),
            F.when(F.col("id") % 100 == 0, "20240102").otherwise("20240101").alias("partition_date"),
        )
        path = str(tmp_path / "t")
        replace_partitions(df, path)
        files = lambda day: list((tmp_path / "t" / f"partition_date={day}").glob("*.parquet"))
        assert len(files("20240101")) > 4 and len(files("20240102")) <= 2
        assert spark.read.parquet(path).count() == 200000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["fact_trip_schedule", "fact_stop_event"])
def test_rows_multiplied_by_the_calendar_are_not_shuffled(spark, sf_dir, name):
    lines = plan_of(QUERIES[name](spark, sf_dir)).splitlines()
    first_join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert "[service_id" in lines[first_join]
    assert not any("Exchange" in line for line in lines[:first_join])


def test_scans_read_only_what_is_needed(spark, sf_dir):
    plan = plan_of(QUERIES["trips_by_date"](spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_share_of_total_reuses_the_shuffle(spark, sf_dir):
    df = QUERIES["stops_by_municipality"](spark, sf_dir)
    df.collect()
    assert "ReusedExchange" in plan_of(df) and "Window" not in plan_of(df)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 2
    # Every query of the schedule library has its SQL; no SQL is without its query.
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    json.dumps(entry.oracle_sql())


def test_rows_that_inputs_widen_are_dealt_to_tasks_by_size(spark, sf_dir, monkeypatch):
    from headway.catalogue import inputs

    whole = inputs.Inputs(spark, sf_dir)("raw_endpoint_routes")
    monkeypatch.setattr(inputs, "WIDENED_BYTES", 500)
    pieces = inputs.Inputs(spark, sf_dir).table("customer").rdd.getNumPartitions()
    assert pieces > 1
    dealt = inputs.Inputs(spark, sf_dir)("raw_endpoint_routes")
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()
