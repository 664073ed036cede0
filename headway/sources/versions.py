"""Tables whose days are replaced at once: written to a folder of their own, then named by a commit.

Layout of one table
    days/version=<write>/partition_date=<day>/    the rows of a day as one write left them
    commits/<write>~<day>, commits/<write>~all    an empty file, made last: what the write replaced

A write never touches a folder that a reader may have listed: the day it replaces stays in force until
the commit is there, and a write that dies half way leaves the table as it was. Scans take the list
of folders in force from the names of the commits: one listing tells them, and one more the days of the
last write of the whole table. No Spark job reads or writes them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from headway.schemas import PARTITION_COLUMN
from headway.sources.tables import PACKED, partition_values, unsorted_writes

VERSION = "version"
ALL = "all"


@dataclass(frozen=True)
class InForce:
    """The last write, and for each day the write that its rows are of."""

    last: str
    days: dict[str, str]


def in_force(spark: SparkSession, path: str, partition: str = PARTITION_COLUMN) -> InForce | None:
    """What the commits name; None for a table without any.

    A write of the whole table puts all earlier ones out of force. Newer writes have greater names.
    """
    commits = sorted(tuple(name.split("~", 1)) for name in _commits(spark, path))
    if not commits:
        return None
    days: dict[str, str] = {}
    wholes = [i for i, (_, day) in enumerate(commits) if day == ALL]
    if wholes:
        whole = commits[wholes[-1]][0]
        days = dict.fromkeys(partition_values(spark, f"{path}/days/{VERSION}={whole}", partition), whole)
    days |= {day: version for version, day in commits[wholes[-1] + 1 if wholes else 0 :]}
    return InForce(commits[-1][0], dict(sorted(days.items())))


def _commits(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return [n for n in (status.getPath().getName() for status in files.listStatus(folder)) if "~" in n]


def is_versioned(spark: SparkSession, path: str) -> bool:
    return in_force(spark, path) is not None


def replace_day_at_once(df: DataFrame, path: str, day: str, partition: str = PARTITION_COLUMN) -> None:
    """Make the rows of `df`, all of `day`, that day of the table. Without rows the day becomes empty."""
    version = _next_version(df.sparkSession, path)
    df.drop(partition).write.options(**PACKED).parquet(f"{path}/days/{VERSION}={version}/{partition}={day}")
    _commit(df.sparkSession, path, version, day)


def replace_all_at_once(df: DataFrame, path: str, partition: str = PARTITION_COLUMN, gather: bool = True) -> None:
    """Make the rows of `df` the whole table; it may read the table as it was.

    gather: shuffle the rows of a day together first. Without it each task adds a file to every day it has rows
    of, which suits few days.
    """
    spark = df.sparkSession
    version = _next_version(spark, path)
    folder = f"{path}/days/{VERSION}={version}"
    unsorted_writes(spark)
    # Adaptive execution splits a day of many rows over tasks, and gives a small one a single file.
    rows = df.hint("rebalance", partition) if gather else df
    rows.write.options(**PACKED).partitionBy(partition).parquet(folder)
    _commit(spark, path, version, ALL)


def folders_in_force(spark: SparkSession, path: str, partition: str = PARTITION_COLUMN) -> dict[str, str]:
    """Day, as folders are named by, to the folder with its rows; days in order."""
    state = in_force(spark, path, partition)
    if state is None:
        return {}
    return {day: f"{path}/days/{VERSION}={v}/{partition}={day}" for day, v in state.days.items()}


def read_days(
    spark: SparkSession, path: str, schema: StructType | None = None, partition: str = PARTITION_COLUMN
) -> DataFrame:
    """The table as of its last commit."""
    folders = list(folders_in_force(spark, path, partition).values())
    if not folders:
        raise ValueError(f"no day of a table is in force under {path}")
    reader = spark.read.option("basePath", f"{path}/days")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*folders).drop(VERSION)


def superseded(spark: SparkSession, path: str) -> list[str]:
    """Folders of writes that have no day in force: what whoever owns the table can delete once no reader
    is left that started before the last commit."""
    state = in_force(spark, path)
    if state is None:
        return []
    # The newest writes may not have committed yet.
    written = [v for v in partition_values(spark, f"{path}/days", VERSION) if v <= state.last]
    return [f"{path}/days/{VERSION}={v}" for v in written if v not in set(state.days.values())]


def _next_version(spark: SparkSession, path: str) -> str:
    """Later than every committed write, whatever the clocks of the machines say."""
    state = in_force(spark, path)
    number = 1 if state is None else int(state.last[1:13]) + 1
    return f"v{number:012d}-{uuid.uuid4().hex[:8]}"


def _commit(spark: SparkSession, path: str, version: str, day: str) -> None:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits/{version}~{day}")
    if not marker.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(marker):
        raise FileExistsError(f"{marker} is there already")
