import datetime as dt

from pyspark.sql import functions as F

from headway.operators.cleaning import (
    fill_missing,
    flatten_structs,
    json_to_array,
    nested_to_json,
    normalise_sentinels,
)
from headway.sources.staging import parse_partition_date, stage


def test_fill_touches_only_floats_and_text(spark):
    df = spark.createDataFrame(
        [(float("nan"), None, None, None), (None, "x", 3, True), (1.5, "NaN", None, False)],
        "d double, s string, n bigint, b boolean",
    )
    assert [tuple(r) for r in fill_missing(df).collect()] == [
        (0.0, "UNKNOWN", None, None),
        (0.0, "x", 3, True),
        (1.5, "NaN", None, False),
    ]
    assert fill_missing(df).dtypes == df.dtypes


def test_fill_handles_single_precision(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,)], "f float")
    assert [r.f for r in fill_missing(df).collect()] == [0.0, 0.0, 2.0]


def test_sentinels_are_replaced_inside_values_unless_exact(spark):
    df = spark.createDataFrame([("NaN",), ("xNaNx",), ("UNKNOWN",), ("ok",), (None,)], "v string")
    assert [r.v for r in normalise_sentinels(df, ["v"]).collect()] == ["N/A", "xN/Ax", "N/A", "ok", None]
    assert [r.v for r in normalise_sentinels(df, ["v"], exact=True).collect()] == [
        "N/A", "xNaNx", "N/A", "ok", None,
    ]


def test_json_to_array(spark):
    df = spark.createDataFrame(
        [('["a","b"]',), ("[]",), ("UNKNOWN",), ('["a"',), (None,), ('["é"]',)], "v string"
    )
    assert [r.v for r in json_to_array(df, ["v", "absent"]).collect()] == [
        ["a", "b"], [], None, None, None, ["é"],
    ]


def test_nested_to_json_and_flatten(spark):
    df = spark.range(1).select(
        "id",
        F.struct(F.lit("é").alias("city"), F.struct(F.lit(1).alias("zip")).alias("area")).alias("place"),
        F.array(F.lit("x")).alias("tags"),
        F.create_map(F.lit("k"), F.lit(2)).alias("extra"),
    )
    assert tuple(nested_to_json(df).first()) == (
        0, '{"city":"é","area":{"zip":1}}', '["x"]', '{"k":2}',
    )
    flat = flatten_structs(df)
    assert flat.columns == ["id", "place.city", "place.area.zip", "tags", "extra"]
    assert tuple(nested_to_json(flat).first()) == (0, "é", 1, '["x"]', '{"k":2}')


def test_stage_stamps_dates_and_drops_copies(spark):
    df = spark.createDataFrame(
        [("a", None, "20240101"), ("a", None, "20240101"), ("a", None, "20240102"), ("a", None, "bad")],
        "trip_id string, dist double, partition_date string",
    )
    rows = stage(df).collect()
    assert len(rows) == 3
    assert {r.partition_date for r in rows} == {dt.date(2024, 1, 1), dt.date(2024, 1, 2), None}
    assert {r.dist for r in rows} == {0.0}
    assert len({r.ingested_at for r in rows}) == 1
    assert parse_partition_date(df).schema["partition_date"].dataType.simpleString() == "date"
