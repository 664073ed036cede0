"""Parquet tables: paths, scans and sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from headway.schemas import PARTITION_COLUMN

T = TypeVar("T")

#: How tables are written. Keys that are hashes in text take most of the large ones: Spark's default packs
#: repeats only, which these have none of, and leaves them twice as large.
#: Spark reads no less than a row group in a task: at parquet's 128 MB a task would hold some gigabytes of rows.
ROW_GROUP_BYTES = 32 * 1024 * 1024
PACKED = {"compression": "zstd", "parquet.block.size": str(ROW_GROUP_BYTES)}

#: Files that a task keeps open: more days than a feed plans ahead.
OPEN_FILES = 400
OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"

# How many tables are built at a time.
CONCURRENT_TABLES = 4


def in_parallel(writes: Iterable[Callable[[], T]]) -> list[T]:
    """Run independent table writes a few at a time, so that small tables fill the cluster together."""
    with ThreadPoolExecutor(CONCURRENT_TABLES) as pool:
        return [done.result() for done in [pool.submit(write) for write in writes]]


def raw_path(root: str, source: str, entity: str) -> str:
    """Where the raw layer keeps `entity` of a source: API entities on top, feed members below gtfs/."""
    if source == "endpoint":
        return f"{root}/{entity}"
    if source == "gtfs":
        return f"{root}/gtfs/{entity}"
    raise ValueError(f"unknown source: {source}")


def entity_name(endpoint: str) -> str:
    """Table name of an API endpoint: /facilities/schools becomes facilities_schools."""
    return endpoint.replace("/", "_").strip("_")


def read_with_schema(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan of a parquet table under a declared schema: nothing is inferred, absent columns are NULL."""
    return spark.read.schema(schema).parquet(path)


def partition_values(spark: SparkSession, path: str, partition: str = PARTITION_COLUMN) -> list[str]:
    """The values of a table's outermost partition column, ascending, from the names of its folders.

    One listing of the table's own folder; no file is listed or opened.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [
        status.getPath().getName()
        for status in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    ]
    prefix = f"{partition}="
    return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))


def replace_day(df: DataFrame, path: str, day: str, partition: str = PARTITION_COLUMN) -> None:
    """Make the rows of `df` one partition of the table, in place of what it held.

    All rows belong to `day`. Without rows the partition becomes empty, which an overwrite
    of only those partitions that have rows would not do. Other days stay.
    """
    df.drop(partition).write.mode("overwrite").options(**PACKED).parquet(f"{path}/{partition}={day}")


def replace_partitions(df: DataFrame, path: str, partition: str = PARTITION_COLUMN) -> None:
    """Overwrite only the partitions that `df` holds; the other days of the table stay."""
    replace_one_partition(_by_partition(df, partition), path, partition)


def replace_one_partition(df: DataFrame, path: str, partition: str = PARTITION_COLUMN) -> None:
    """The same for rows that all belong to one partition: no shuffle is needed to gather them."""
    unsorted_writes(df.sparkSession)
    (
        df.write.mode("overwrite")
        .options(**PACKED)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def unsorted_writes(spark: SparkSession) -> None:
    """Has the session keep the files of a task open, unless it says how many: rows of several days are then
    written as they come. Otherwise Spark sorts a task's rows by day first, on disk where they are many."""
    if int(spark.conf.get(OPEN_FILES_SETTING)) == 0:
        spark.conf.set(OPEN_FILES_SETTING, str(OPEN_FILES))


def replace_table(
    df: DataFrame, path: str, partition: str | None = None, gather: bool = True
) -> None:
    """Overwrite the whole table. `path` must not be one that `df` reads.

    gather: shuffle the rows of a partition together first. Without it each task adds
    a file to every partition it has rows of, which suits rows that a last join with
    the days has just multiplied: a task of 64 MB before that join writes a file of
    about that size per day, and the multiplied rows are never shuffled.
    """
    if partition is None:
        df.write.mode("overwrite").options(**PACKED).option("partitionOverwriteMode", "static").parquet(path)
        return
    unsorted_writes(df.sparkSession)
    rows = _by_partition(df, partition) if gather else df
    (
        rows.write.mode("overwrite")
        .options(**PACKED)
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition)
        .parquet(path)
    )


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make each DataFrame a temporary view under its name, for use from SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def _by_partition(df: DataFrame, partition: str) -> DataFrame:
    """Gather rows of one partition value so that a day is a few large files.

    REBALANCE rather than repartition: adaptive execution splits a value that holds
    a large share of the rows over many tasks, and joins small ones.
    """
    return df.hint("rebalance", partition)
