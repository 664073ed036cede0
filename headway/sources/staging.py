"""Staging: raw tables to clean, typed, deduplicated tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.cleaning import fill_missing, json_to_array
from headway.operators.merge import MERGES, merge_sources
from headway.schemas import INGESTED_AT, PARTITION_COLUMN, raw_schema
from headway.sources.tables import (
    ROW_GROUP_BYTES,
    in_parallel,
    partition_values,
    raw_path,
    read_with_schema,
)
from headway.sources.versions import read_days, replace_all_at_once, replace_day_at_once


@dataclass(frozen=True)
class StagedTable:
    """One staging table: the raw entity and source it comes from, and the schema key it is read with."""

    entity: str
    source: str
    schema: str


# The entities that are staged and the sources each comes from.
ENTITIES = {
    "lines": ("endpoint",),
    "routes": ("endpoint", "gtfs"),
    "stops": ("endpoint", "gtfs"),
    "stop_times": ("gtfs",),
    "trips": ("gtfs",),
    "periods": ("gtfs",),
    "dates": ("gtfs",),
    "calendar_dates": ("gtfs",),
    "shapes": ("gtfs",),
    "municipalities": ("gtfs",),
}

#: Bytes of packed raw files that a task reads. Copies are sought among all its rows before these are shuffled,
#: and unpacked rows take some twenty times as much: of Spark's default of 128 MB most would go to disk.
READ_BYTES = ROW_GROUP_BYTES
READ_SETTING = "spark.sql.files.maxPartitionBytes"

#: Days of a table that is rebuilt, up to which a task adds a file to each rather than gather their rows.
FEW_DAYS = 4

# The JSON text columns that become arrays, per table.
ARRAY_COLUMNS = {
    "stops": ("facilities", "line_ids", "pattern_ids", "route_ids"),
    "routes": (
        "district_ids", "facilities", "locality_ids", "municipality_ids", "pattern_ids",
        "region_ids", "stop_ids",
    ),
    "lines": (
        "district_ids", "facilities", "locality_ids", "municipality_ids", "pattern_ids",
        "region_ids", "route_ids", "stop_ids",
    ),
}


def staged_tables() -> Iterator[StagedTable]:
    """Every staging table. An entity with several sources has one table per source."""
    for entity, sources in ENTITIES.items():
        for source in sources:
            schema = entity if len(sources) == 1 else f"{source}_{entity}"
            yield StagedTable(entity, source, schema)


def staging_path(root: str, table: str) -> str:
    return f"{root}/staging_{table}"


def read_staged(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A staging table as of its last committed write."""
    return read_days(spark, staging_path(root, table))


def parse_partition_date(df: DataFrame) -> DataFrame:
    """The extraction day from `yyyyMMdd` text to a date; unparseable text gives NULL."""
    return df.withColumn(PARTITION_COLUMN, F.try_to_date(PARTITION_COLUMN, "yyyyMMdd"))


def stage(raw: DataFrame, run_at: Column | None = None) -> DataFrame:
    """Raw rows stamped, dated, filled, and without copies.

    The stamp is one value per run, so it does not keep copies apart. Copies are
    dropped map-side before the shuffle, so a group of copies is no hot spot.
    """
    stamped = raw.withColumn(INGESTED_AT, F.current_timestamp() if run_at is None else run_at)
    return fill_missing(parse_partition_date(stamped)).dropDuplicates()


def small_reads(spark: SparkSession) -> None:
    """Has the session read files in pieces of READ_BYTES, unless it has smaller ones. That changes no rows."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(READ_SETTING))
    if size > READ_BYTES:
        spark.conf.set(READ_SETTING, str(READ_BYTES))


def stage_table(
    spark: SparkSession,
    raw_root: str,
    staging_root: str,
    table: StagedTable,
    run_at: Column | None = None,
    day: str | None = None,
) -> str:
    """Write one staging table and return its path.

    Without `day` the table is rebuilt from all extraction days. With `day`
    (`yyyyMMdd`) only that day is read and replaced. The rows are the same but for
    their stamp: the day is part of every row, so copies never span two days.
    """
    small_reads(spark)
    raw = read_with_schema(
        spark, raw_path(raw_root, table.source, table.entity), raw_schema(table.schema)
    )
    path = staging_path(staging_root, table.schema)
    if day is None:
        # The shuffle that finds copies fills its tasks: rows of few days are not shuffled again to gather these.
        days = partition_values(spark, raw_path(raw_root, table.source, table.entity))
        replace_all_at_once(stage(raw, run_at), path, gather=len(days) > FEW_DAYS)
        return path
    date = dt.datetime.strptime(day, "%Y%m%d").date()
    return _write(stage(raw.where(F.col(PARTITION_COLUMN) == day), run_at), path, date)


def stage_all(
    spark: SparkSession,
    raw_root: str,
    staging_root: str,
    run_at: Column | None = None,
    day: str | None = None,
) -> dict[str, str]:
    """Write every staging table; returns table name to path."""
    tables = list(staged_tables())
    paths = in_parallel(
        partial(stage_table, spark, raw_root, staging_root, t, run_at, day) for t in tables
    )
    return {t.schema: path for t, path in zip(tables, paths)}


def merge_staged(
    spark: SparkSession,
    staging_root: str,
    entity: str,
    run_at: Column | None = None,
    match_partition: bool = True,
    day: dt.date | None = None,
) -> str:
    """Write the merged table of an entity that has both sources.

    With `day` only that extraction day is merged and replaced, which needs
    `match_partition`: otherwise a day's rows depend on all retained days.
    """
    if day is not None and not match_partition:
        raise ValueError("a single day can only be merged when extraction days must match")
    endpoint = read_staged(spark, staging_root, f"endpoint_{entity}")
    feed = read_staged(spark, staging_root, f"gtfs_{entity}")
    if day is not None:
        endpoint = endpoint.where(F.col(PARTITION_COLUMN) == F.lit(day))
        feed = feed.where(F.col(PARTITION_COLUMN) == F.lit(day))
    merged = merge_sources(
        endpoint, feed, MERGES[entity], match_partition, endpoint_has_copies=False
    ).withColumn(INGESTED_AT, F.current_timestamp() if run_at is None else run_at)
    return _write(merged, staging_path(staging_root, entity), day)


def convert_staged(
    spark: SparkSession, staging_root: str, table: str, day: dt.date | None = None
) -> str:
    """Write the `_converted` form of a table, with its JSON text columns as arrays."""
    staged = read_staged(spark, staging_root, table)
    if day is not None:
        staged = staged.where(F.col(PARTITION_COLUMN) == F.lit(day))
    converted = json_to_array(staged, ARRAY_COLUMNS[table])
    return _write(converted, staging_path(staging_root, f"{table}_converted"), day)


def _write(df: DataFrame, path: str, day: dt.date | None) -> str:
    """Replace one day, or the whole table, at once: readers see it as it was until all is written."""
    if day is None:
        replace_all_at_once(df, path)
    else:
        replace_day_at_once(df, path, day.isoformat())
    return path
