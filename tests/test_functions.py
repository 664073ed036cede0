import datetime as dt

from pyspark.sql import functions as F

from headway.functions.aggregates import distinct_text
from headway.functions.gtfs import (
    clock_text,
    gtfs_clock_time,
    gtfs_seconds,
    is_one,
    is_weekend,
    parse_gtfs_date,
    peak_flag,
    trip_duration_minutes,
)
from headway.functions.keys import NULL_TOKEN, surrogate_key


def one_column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_gtfs_seconds(spark):
    texts = ["00:00:00", "25:10:00", "7:05:09", "07:05", "7", "UNKNOWN", "aa:bb:cc", "", None, "1:2:3:4"]
    assert one_column(spark, texts, "string", gtfs_seconds) == [
        0, 90600, 25509, None, None, None, None, None, None, 3723,
    ]


def test_clock_wraps_past_midnight(spark):
    clock = lambda c: clock_text(gtfs_clock_time(c))
    assert one_column(spark, ["25:10:00", "24:00:00", "23:59:59", "48:00:01"], "string", clock) == [
        "01:10:00", "00:00:00", "23:59:59", "00:00:01",
    ]


def test_parse_gtfs_date(spark):
    assert one_column(spark, [20240229, 20240231, None], "bigint", parse_gtfs_date) == [
        dt.date(2024, 2, 29), None, None,
    ]
    assert one_column(spark, ["20240101", "UNKNOWN"], "string", parse_gtfs_date) == [
        dt.date(2024, 1, 1), None,
    ]


def test_peak_windows_include_both_ends(spark):
    times = ["06:59:59", "07:00:00", "09:00:00", "09:00:01", "16:59:59", "17:00:00", "20:00:00", "20:00:01", None]
    flag = lambda c: peak_flag(gtfs_clock_time(c), F.lit(1), F.lit(1), F.lit(0))
    assert one_column(spark, times, "string", flag) == [
        False, True, True, False, False, True, True, False, False,
    ]


def test_peak_days(spark):
    rows = [(1, 1, 0), (2, 1, 0), (1, 2, 0), (1, 1, 1), (None, 1, 0), (1, None, 0), (1, 1, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d int, e int, h int")
    peak = F.lit(8 * 3600)
    got = df.orderBy("i").select(
        peak_flag(peak, F.col("d")),
        peak_flag(peak, F.col("d"), F.col("e")),
        peak_flag(peak, F.col("d"), F.col("e"), F.col("h")),
    )
    assert [tuple(r) for r in got.collect()] == [
        (True, True, True),
        (False, False, False),
        (True, False, False),
        (True, True, False),
        (False, False, False),
        (True, False, False),
        (True, True, False),
    ]


def test_duration_rounds_half_away_from_zero(spark):
    assert one_column(spark, [150, -150, 89, 90, None], "bigint", lambda c: trip_duration_minutes(F.lit(0), c)) == [
        3.0, -3.0, 1.0, 2.0, None,
    ]


def test_flags_treat_null_as_false(spark):
    assert one_column(spark, [1.0, 0.0, 2.0, None], "double", is_one) == [True, False, False, False]
    assert one_column(spark, [1, 2, 3, 4, None], "bigint", is_weekend) == [False, True, True, False, False]


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 4
    expected = spark.range(1).select(F.md5(F.lit(f"a-{NULL_TOKEN}"))).first()[0]
    assert keys[0] == expected


def test_distinct_text(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string"
    )
    got = df.groupBy("k").agg(distinct_text(F.col("v"), ", ").alias("t"), F.count_distinct("v").alias("n"))
    assert {r.k: (r.t, r.n) for r in got.collect()} == {1: ("a, b", 2), 2: (None, 0)}
