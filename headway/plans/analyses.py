"""The business questions, asked of the facts or of their roll-ups.

`schedule` is fact_trip_schedule and `events` is fact_stop_event. A roll-up of
either serves as well: `weight` names its count column, which is added up where a
fact has its rows counted. Sort orders end in a key, so they are total and a range
sort can split rows that tie on the leading column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.aggregates import distinct_text


def avgtime_trip(schedule: DataFrame, weight: str | None = None) -> DataFrame:
    """How long does a trip take on average? Trips of unknown or no duration are left out."""
    timed = schedule.where(F.col("duration_minutes") > 0)
    minutes = F.col("duration_minutes")
    if weight is None:
        measures = timed.agg(
            F.avg(minutes).alias("mean"),
            F.min(minutes).alias("least"),
            F.max(minutes).alias("most"),
            F.stddev_samp(minutes).alias("deviation"),
            F.count(F.lit(1)).alias("trips"),
        )
    else:
        measures = _weighted_moments(timed, minutes, F.col(weight))
    return measures.select(
        F.round("mean", 2).alias("avg_trip_duration_minutes"),
        F.round("least", 2).alias("min_duration_minutes"),
        F.round("most", 2).alias("max_duration_minutes"),
        F.round("deviation", 2).alias("stddev_duration_minutes"),
        F.col("trips").alias("total_trips_analyzed"),
    )


def distance_trip(schedule: DataFrame) -> DataFrame:
    """What distance does each trip cover?"""
    return (
        schedule.where(F.col("distance_km") > 0)
        .select(
            "trip_id",
            "trip_date",
            "route_id",
            F.col("distance_km").alias("total_distance_km"),
            "duration_minutes",
        )
        .orderBy(F.desc("total_distance_km"), "trip_id", "trip_date")
    )


def trips_by_date(schedule: DataFrame, weight: str | None = None) -> DataFrame:
    """How many trips are scheduled per day?"""
    return (
        schedule.groupBy("trip_date")
        .agg(_rows(weight).alias("total_trips_scheduled"))
        .orderBy(F.desc("trip_date"))
    )


def peak_schedule(schedule: DataFrame, weight: str | None = None) -> DataFrame:
    """How many trips run at peak and off peak?"""
    per_flag = schedule.groupBy("is_peak").agg(_rows(weight).alias("trip_count"))
    return _with_share(per_flag, "trip_count").orderBy(F.desc("is_peak"))


def daily_line_frequency(events: DataFrame, weight: str | None = None) -> DataFrame:
    """How often does each line call at each stop per day?"""
    served = ["stop_id", "stop_name", "line_id", "line_short_name", "line_long_name"]
    per_day = events.groupBy(*served, "stop_event_date").agg(_rows(weight).alias("n"))
    return (
        per_day.groupBy(*served)
        .agg(
            F.round(F.avg("n"), 0).alias("avg_daily_frequency"),
            F.min("n").alias("min_daily_frequency"),
            F.max("n").alias("max_daily_frequency"),
            F.sum("n").alias("total_frequency"),
            F.count("stop_event_date").alias("days_operated"),
        )
        .orderBy(F.desc("avg_daily_frequency"), "stop_id", "line_id")
        .select(
            "stop_name",
            "line_short_name",
            "line_long_name",
            "avg_daily_frequency",
            "min_daily_frequency",
            "max_daily_frequency",
            "total_frequency",
            "days_operated",
        )
    )


def line_frequency(events: DataFrame, line_id: str) -> DataFrame:
    """How often does one line call at each stop?"""
    return (
        events.where(F.col("line_id") == line_id)
        .groupBy("stop_id", "stop_name", "municipality_name")
        .agg(
            F.count(F.lit(1)).alias("total_frequency"),
            F.count_distinct("stop_event_date").alias("days_served"),
            (F.count(F.lit(1)) / F.count_distinct("stop_event_date")).alias(
                "avg_frequency_per_day"
            ),
            F.count_distinct("trip_id").alias("unique_trips"),
            F.min("stop_event_date").alias("first_service_date"),
            F.max("stop_event_date").alias("last_service_date"),
        )
        .orderBy(F.desc("total_frequency"), "stop_id")
    )


def stops_by_municipality(events: DataFrame) -> DataFrame:
    """How many stops does each municipality have, and what share of all?"""
    area = ["municipality_id", "municipality_name", "district_name", "region_name"]
    per_area = events.groupBy(*area).agg(F.count_distinct("stop_id").alias("total_stops"))
    return (
        _with_share(per_area, "total_stops")
        .orderBy(F.desc("total_stops"), "municipality_id")
        .drop("municipality_id")
    )


def stops_by_region(events: DataFrame) -> DataFrame:
    """How many stops does each region have, and what share of all?"""
    per_area = events.groupBy("region_id", "region_name").agg(
        F.count_distinct("stop_id").alias("total_stops")
    )
    return (
        _with_share(per_area, "total_stops")
        .orderBy(F.desc("total_stops"), "region_id")
        .drop("region_id")
    )


def stops_near_school(events: DataFrame, weight: str | None = None) -> DataFrame:
    """Which stops are near a school, and what serves them?"""
    stop = [
        "stop_id",
        "stop_name",
        "municipality_name",
        "district_name",
        "region_name",
        "is_near_school",
    ]
    per_line_day = (
        events.where("is_near_school")
        .groupBy(*stop, "line_id", "line_short_name", "stop_event_date")
        .agg(_rows(weight).alias("n"))
    )
    return (
        per_line_day.groupBy(*stop)
        .agg(
            F.count_distinct("line_id").alias("total_lines_serving"),
            distinct_text(F.col("line_short_name"), ", ").alias("lines_serving"),
            F.sum("n").alias("total_scheduled_arrivals"),
            F.count_distinct("stop_event_date").alias("days_with_service"),
        )
        .orderBy(F.desc("total_lines_serving"), "stop_name", "stop_id")
    )


def top10_lines_for_stop(events: DataFrame) -> DataFrame:
    """Which ten stops have most lines? Ties go to the lower stop id."""
    return (
        _lines_of_stops(events)
        .agg(
            F.count_distinct("line_id").alias("total_lines"),
            distinct_text(F.col("line_short_name"), ", ").alias("lines"),
        )
        .orderBy(F.desc("total_lines"), "stop_id")
        .limit(10)
    )


def which_lines_for_each_stop(events: DataFrame) -> DataFrame:
    """Which lines call at each stop?"""
    detail = F.concat("line_short_name", F.lit(" ("), "line_long_name", F.lit(")"))
    return (
        _lines_of_stops(events)
        .agg(
            distinct_text(F.col("line_short_name"), ", ").alias("lines_serving_stop"),
            F.count_distinct("line_id").alias("total_lines"),
            distinct_text(detail, "; ").alias("lines_with_details"),
        )
        .orderBy(F.desc("total_lines"), "stop_name", "stop_id")
    )


def _lines_of_stops(events: DataFrame):
    """Events grouped by stop, each line once: the copies go map-side, before the sets are built."""
    stop = ["stop_id", "stop_name", "municipality_name"]
    lines = events.select(*stop, "line_id", "line_short_name", "line_long_name").distinct()
    return lines.groupBy(*stop)


def _rows(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def _with_share(counts: DataFrame, column: str) -> DataFrame:
    """Add each row's percentage of the column's total.

    The total is a scalar subquery over the same aggregate, whose shuffle it reuses;
    an unpartitioned window would pull all groups into one task.
    """
    total = counts.agg(F.sum(column)).scalar()
    share = F.round(100.0 * F.col(column) / total, 2)
    return counts.withColumn("percentage_of_total", share)


def _weighted_moments(df: DataFrame, value: Column, weight: Column) -> DataFrame:
    """Mean, extremes and sample deviation of whole-number values that each count `weight` times.

    The sums are exact decimals, so nothing cancels however many rows they stand for.
    """
    exact = "decimal(38,0)"
    v, w = value.cast("bigint").cast(exact), weight.cast(exact)
    n, s, squares = F.col("n"), F.col("s"), F.col("squares")
    spread = (n * squares - s * s).cast("double")
    return df.agg(
        F.sum(w).cast(exact).alias("n"),
        F.sum((v * w).cast(exact)).cast(exact).alias("s"),
        F.sum((v * v * w).cast(exact)).cast(exact).alias("squares"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
    ).select(
        (s.cast("double") / n.cast("double")).alias("mean"),
        "least",
        "most",
        F.when(
            n > 1, F.sqrt(spread / n.cast("double") / (n - 1).cast("double"))
        ).alias("deviation"),
        F.coalesce(n.cast("bigint"), F.lit(0)).alias("trips"),
    )
