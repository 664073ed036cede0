"""Staging rebuilds a table of few days with one shuffle of its rows and no sort, and gathers those of many days."""

import pytest
from pyspark.sql import functions as F

from headway.schemas import raw_schema
from headway.sources import staging
from headway.sources.staging import READ_SETTING, StagedTable, stage_table
from headway.sources.tables import raw_path, replace_table
from headway.sources.versions import read_days


def raw_trips(spark, days):
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in raw_schema("trips")]
    rows = spark.range(0, 40, 1, 4).select("id", *columns)
    rows = rows.withColumns({"trip_id": (F.col("id") % 10).cast("string"), "partition_date": F.explode(F.array(*map(F.lit, days)))})
    return rows.drop("id")


@pytest.mark.parametrize("days", [["20240101", "20240102"], [f"2024010{i}" for i in range(1, 7)]])
def test_rows_of_few_days_are_shuffled_once(spark, tmp_path, monkeypatch, days):
    plans = []

    def written(df, path, partition="partition_date", gather=True):
        plans.append((gather, df._jdf.queryExecution().executedPlan().toString()))
        write(df, path, partition, gather)

    write = staging.replace_all_at_once
    monkeypatch.setattr(staging, "replace_all_at_once", written)
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    replace_table(raw_trips(spark, days), raw_path(raw, "gtfs", "trips"), "partition_date", gather=False)
    path = stage_table(spark, raw, staged, StagedTable("trips", "gtfs", "trips"), F.lit("2024-01-03 04:00:00").cast("timestamp"))
    ((gather, plan),) = plans
    assert gather == (len(days) > staging.FEW_DAYS) and plan.count("Exchange hashpartitioning") == 1
    got = read_days(spark, path).groupBy("partition_date", "trip_id").count().collect()
    assert len(got) == 10 * len(days) and {r["count"] for r in got} == {1}


def test_rows_of_several_days_are_not_sorted_before_they_are_written(spark, tmp_path):
    """A session that keeps no files open would sort them by day."""
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "0")
    replace_table(raw_trips(spark, ["20240101", "20240102"]), str(tmp_path / "t"), "partition_date", gather=False)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 2


def test_reads_are_made_smaller_but_never_larger(spark):
    before = spark.conf.get(READ_SETTING)
    try:
        for size, kept in (("128m", str(staging.READ_BYTES)), ("1m", "1m")):
            spark.conf.set(READ_SETTING, size)
            staging.small_reads(spark)
            assert spark.conf.get(READ_SETTING) == kept
    finally:
        spark.conf.set(READ_SETTING, before)
