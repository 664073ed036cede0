"""Planned files and buckets of the facts."""

import pytest
from pyspark.sql import functions as F

from headway.catalogue.inputs import Inputs
from headway.plans import daily, rollups
from headway.plans.facts import fact_stop_event, fact_trip_schedule
from headway.sources.fact_tables import FactLayout, dealt, is_laid_out, on_days, open_fact, plan_layout, write_fact


@pytest.fixture(scope="module")
def src(spark, sf_dir):
    return Inputs(spark, sf_dir)


def schedule(src, layout=None):
    stamp = F.lit("2024-01-03").cast("timestamp")
    return fact_trip_schedule(src("trips"), src("stop_times"), src("calendar"), run_at=stamp, layout=layout)


def events(src, layout=None):
    names = ("stop_times", "trips", "routes", "calendar", "stops", "municipalities")
    return fact_stop_event(*map(src, names), run_at=F.lit("2024-01-03").cast("timestamp"), layout=layout)


def files_of(folder):
    out = {}
    for f in folder.rglob("*.parquet"):
        out.setdefault(f.parent.name, []).append(f)
    return out


def test_the_plan_follows_the_largest_day(spark):
    counts = spark.createDataFrame([(1, 700), (1, 300), (2, 10), (3, 0)], "day int, n long")
    plan = lambda **o: plan_layout(counts, "k", "day", "n", 10, **o)
    assert plan(file_bytes=10_000, tasks=1) == FactLayout("k", 1, 1)
    assert plan(file_bytes=9_999, tasks=1) == FactLayout("k", 2, 1)
    assert plan(file_bytes=1_000, tasks=25) == FactLayout("k", 10, 3)
    # There are no more slices than days.
    assert plan(file_bytes=10_000, tasks=100) == FactLayout("k", 1, 3)
    assert plan_layout(counts.limit(0), "k", "day", "n", 10) == FactLayout("k", 1, 1)


def test_roll_ups_count_the_facts(spark, src):
    trips, stop_times, calendar = src("trips"), src("stop_times"), src("calendar")
    per_day = rollups.stop_events_by_date(stop_times, trips, calendar)
    planned = {r[0]: r[1] for r in per_day.groupBy("stop_event_date").agg(F.sum("stop_event_count")).collect()}
    made = {r[0]: r[1] for r in events(src).groupBy("stop_event_date").count().collect()}
    assert made and all(planned[day] >= n for day, n in made.items())
    assert daily.fact_layouts(trips, stop_times, calendar)["fact_stop_event"].buckets == 1


@pytest.mark.parametrize("layout", [FactLayout("trip_id", 3, 2), FactLayout("trip_id", 1, 1), FactLayout("trip_id", 5, 7)])
def test_a_day_has_a_file_a_bucket_and_the_rows_are_the_same(spark, src, tmp_path, layout):
    path = tmp_path / "fact"
    write_fact(schedule(src, layout), "planned_schedule", str(path), "trip_date", layout)
    per_day = files_of(path)
    assert per_day and all(len(f) <= layout.buckets for f in per_day.values())
    back = spark.read.parquet(str(path))
    plain = schedule(src).select(back.columns)
    assert back.exceptAll(plain).count() == plain.exceptAll(back).count() == 0
    assert back.count() == plain.count()
    spark.sql("drop table planned_schedule")


def test_multiplied_rows_are_neither_shuffled_nor_sorted(spark, src):
    plan = schedule(src, FactLayout("trip_id", 4, 2))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("BroadcastHashJoin", 1)
    assert "Exchange" not in above and "Sort" not in above and "Exchange" in below


def test_joins_and_groups_on_the_trip_need_no_exchange(spark, src, tmp_path):
    layout = FactLayout("trip_id", 4, 2)
    write_fact(schedule(src, layout), "b_schedule", str(tmp_path / "s"), "trip_date", layout)
    write_fact(events(src, layout), "b_events", str(tmp_path / "e"), "stop_event_date", layout)
    # As a session to come finds them.
    for name in ("b_schedule", "b_events"):
        spark.sql(f"drop table {name}")
    s, e = open_fact(spark, "b_schedule", str(tmp_path / "s")), open_fact(spark, "b_events", str(tmp_path / "e"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        calls = s.groupBy("trip_id").agg(F.count("*").alias("days"))
        joined = e.join(calls, "trip_id").select("trip_id", "stop_id", "days")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        plain = events(src).join(schedule(src).groupBy("trip_id").agg(F.count("*").alias("days")), "trip_id")
        assert joined.count() == plain.count()
        assert joined.agg(F.sum("days")).first() == plain.agg(F.sum("days")).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("b_schedule", "b_events"):
            spark.sql(f"drop table {name}")


def test_no_rows_and_no_days(spark, src, tmp_path):
    layout = FactLayout("trip_id", 2, 2)
    write_fact(schedule(src, layout).limit(0), "empty_fact", str(tmp_path / "f"), "trip_date", layout)
    assert is_laid_out(spark, str(tmp_path / "f")) and not is_laid_out(spark, str(tmp_path / "g"))
    assert spark.table("empty_fact").count() == 0
    spark.sql("drop table empty_fact")
    with pytest.raises(ValueError):
        open_fact(spark, "none", str(tmp_path / "g"))


def test_every_bucket_lies_in_one_partition(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("trip_id"))
    placed = dealt(df, FactLayout("trip_id", 4, 3)).withColumn("p", F.spark_partition_id())
    seen = placed.groupBy("p").agg(F.countDistinct(F.pmod(F.hash("trip_id"), F.lit(4)), "_slice").alias("n"), F.count("*").alias("rows"))
    assert [r.n for r in seen.collect()] == [1] * 12 and placed.count() == 3000


def test_rows_go_to_the_slices_their_service_runs_in(spark):
    rows = spark.createDataFrame([("a", "S"), ("b", "T"), ("c", "never"), ("d", None)], "trip_id string, service_id string")
    days = spark.createDataFrame([("S", 0), ("S", 7), ("T", 1), ("T", 2), (None, 3)], "service_id string, n int")
    days = days.select("service_id", F.date_add(F.lit("1970-01-01").cast("date"), F.col("n")).alias("service_date"))
    made = on_days(rows, days, FactLayout("trip_id", 2, 7))
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, on_days(rows, days).select(made.columns).collect()))
    slices = spark.createDataFrame([("a", [0]), ("b", [1, 2]), ("c", [])], "trip_id string, _slices array<int>")
    placed = dealt(slices, FactLayout("trip_id", 2, 7)).select("trip_id", "_slice").collect()
    assert sorted(map(tuple, placed)) == [("a", 0), ("b", 1), ("b", 2)]


def test_a_fact_is_written_packed_and_unsorted(spark, src, tmp_path):
    import pyarrow.parquet as pq

    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "0")
    layout = FactLayout("trip_id", 2, 2)
    try:
        write_fact(schedule(src, layout), "packed_fact", str(tmp_path / "f"), "trip_date", layout)
        assert int(spark.conf.get(setting)) > 0
    finally:
        spark.conf.set(setting, before)
        spark.sql("drop table if exists packed_fact")
    parts = [pq.read_metadata(f) for files in files_of(tmp_path / "f").values() for f in files]
    assert parts and {m.row_group(0).column(0).compression for m in parts} == {"ZSTD"}
