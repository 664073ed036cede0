import pytest
from pyspark.sql import functions as F

from headway.catalogue import queries as catalogue
from headway.catalogue.inputs import Inputs
from headway.operators.quality import (
    ContractViolation,
    check_columns,
    check_report,
    contract_violations,
    enforce_contract,
    first_look,
    not_null_report,
    repeated_values,
    unique_report,
)
from headway.plans.contracts import ALL, NOT_NULL, UNIQUE, check_model
from headway.plans.staging_views import DATE_COLUMNS, TRIP_COLUMNS
from headway.schemas import columns, feed_schema


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(1, "a"), (1, None), (2, "b"), (None, None), (None, "b")], "id bigint, name string"
    )


def failures(report):
    return {(r.column_name, r.check_name): r.failures for r in report.collect()}


def test_not_null(df):
    assert failures(not_null_report(df, ["id", "name"])) == {
        ("id", "not_null"): 2, ("name", "not_null"): 2,
    }
    assert failures(not_null_report(df.where("false"), ["id"])) == {("id", "not_null"): 0}


def test_unique_ignores_null(df):
    assert failures(unique_report(df, ["id", "name"])) == {("id", "unique"): 1, ("name", "unique"): 1}
    assert [tuple(r) for r in repeated_values(df, "id").collect()] == [(1, 2)]


def test_contract(df):
    good = columns("name string, id bigint")
    assert enforce_contract(df, good, "t").columns == ["name", "id"]
    bad = columns("id double, name string, extra date")
    assert contract_violations(df.withColumn("more", F.lit(1)).schema, bad) == [
        ("id", "double", "bigint"), ("extra", "date", "missing"), ("more", "missing", "int"),
    ]
    with pytest.raises(ContractViolation, match="extra: promised date, found missing"):
        enforce_contract(df, bad, "t")


def test_declared_checks(spark):
    """130 declared not-null and 11 unique checks."""
    audit = 3  # lineage, stamp and day
    all_columns = {
        "stg_periods": len(feed_schema("periods")) + audit,
        "stg_shapes": len(feed_schema("shapes")) + audit,
        "stg_municipalities": len(feed_schema("municipalities")) + audit,
        "stg_calendar_service": len(feed_schema("calendar_dates")) + 1 + audit,
        "stg_dates": len(DATE_COLUMNS) + 1,
        "stg_stop_times": len(feed_schema("stop_times")) + audit,
        "stg_trips": len(TRIP_COLUMNS),
        "fact_trip_schedule": 16,
        "dim_calendar_service": 7,
        "dim_stop": 11,
        "dim_trip": 9,
    }
    total = sum(all_columns[m] if c == ALL else len(c.split()) for m, c in NOT_NULL.items())
    assert total == 130
    assert sum(len(c.split()) for c in UNIQUE.values()) == 11


def test_check_model(spark):
    df = spark.createDataFrame([("r1", "l"), ("r1", None)], "route_id string, line_id string").withColumns(
        {c: F.lit("x") for c in ("locality_ids", "pattern_ids", "region_ids", "partition_date", "ingested_at")}
    )
    report = {(model, column, check): n for model, column, check, n in check_model("stg_routes", df)}
    assert report["stg_routes", "line_id", "not_null"] == 1
    assert report["stg_routes", "route_id", "unique"] == 1
    assert len(report) == 8


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_and_one_shuffle_for_all_columns(spark, tmp_path):
    wide = spark.range(5000).selectExpr("id", "cast(id as string) name", "if(id % 7 = 0, null, id) gap", "id % 10 few")
    wide.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(first_look(table, ["name", "gap", "few"], ["id", "name", "few"])).split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1
    # The rows are shuffled once, after copies are removed; the totals of the tasks meet in one.
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange SinglePartition") == 1
    assert plan.index("Exchange SinglePartition") < plan.index("Exchange hashpartitioning") < plan.rindex("HashAggregate") < plan.index("Expand")
    assert check_columns(table, ["name", "gap", "few"], ["id", "name", "few"]) == [
        ("name", "not_null", 0), ("gap", "not_null", 715), ("few", "not_null", 0),
        ("id", "unique", 0), ("name", "unique", 0), ("few", "unique", 10),
    ]


def test_shared_hashes_are_told_apart_by_value(spark, monkeypatch):
    from headway.operators import quality

    monkeypatch.setattr(quality, "_hash_of", lambda c, kind: F.length(F.col(c).cast("string")).cast("long"))
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("dd",), ("dd",), (None,), (None,)], "x string")
    assert check_columns(df, ["x"], ["x"]) == [("x", "not_null", 2), ("x", "unique", 1)]


def test_columns_of_every_kind(spark):
    df = spark.createDataFrame(
        [(0.0, [1], None), (-0.0, [1], None), (float("nan"), [None], None), (float("nan"), None, None)],
        "d double, a array<int>, n int",
    )
    assert check_columns(df, ["d", "a", "n"], ["d", "a", "n"]) == [
        ("d", "not_null", 0), ("a", "not_null", 1), ("n", "not_null", 4),
        ("d", "unique", 2), ("a", "unique", 1), ("n", "unique", 0),
    ]
    assert check_columns(df.limit(0), ["d"], ["a"]) == [("d", "not_null", 0), ("a", "unique", 0)]
    assert check_columns(df, [], []) == []
    assert check_report(df, ["n"], []).collect()[0].failures == 4


def test_views_that_merge_sources_are_checked_as_written(spark, sf_dir, monkeypatch):
    for name in ("dim_calendar_service", "dim_line", "dim_stop", "dim_trip", "fact_trip_schedule", "fact_stop_event"):
        monkeypatch.setattr(catalogue, name, catalogue.stg_periods)
    for name in ("snapshot_dim_line", "snapshot_dim_stop", "snapshot_dim_trip"):
        monkeypatch.setattr(catalogue, name, catalogue.stg_periods)
    src = Inputs(spark, sf_dir)
    models = catalogue._models(src)
    for name in ("stg_routes", "stg_stops"):
        assert "Exchange" not in models[name]._jdf.queryExecution().executedPlan().toString()
        view = catalogue.VIEW_QUERIES[name](src)
        assert [f.dataType for f in models[name].schema] == [f.dataType for f in view.schema]
        assert models[name].exceptAll(view).isEmpty() and view.exceptAll(models[name]).isEmpty()
