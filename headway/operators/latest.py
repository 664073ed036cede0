"""Rows of the latest extraction day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.schemas import PARTITION_COLUMN
from headway.sources.tables import partition_values
from headway.sources.versions import folders_in_force, is_versioned


#: Name of the folder of rows without a day.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def newest_day(spark: SparkSession, path: str, column: str = PARTITION_COLUMN) -> dt.date | None:
    """The newest day that a table on disk holds rows of; None if it holds none.

    Read off the names of the partition folders, or off the commits of a table that has them. From
    the newest on, a day is asked for one row: a day that was landed again without rows has a folder,
    but is not the latest.
    """
    if is_versioned(spark, path):
        folders = folders_in_force(spark, path, column)
    else:
        folders = {v: f"{path}/{column}={v}" for v in partition_values(spark, path, column)}
    for value, folder in sorted(folders.items(), reverse=True):
        if value != NO_VALUE and not spark.read.parquet(folder).isEmpty():
            return dt.date.fromisoformat(value)
    return None


def latest_partition(
    df: DataFrame,
    anchor: DataFrame | None = None,
    day: dt.date | None = None,
    column: str = PARTITION_COLUMN,
) -> DataFrame:
    """Keep the rows of the newest day of `anchor` (of `df` itself by default).

    `day`: the newest day, where the caller knows it, as `newest_day` reads it off the
    folders of a table on disk. Otherwise it is a scalar subquery in a filter: the scan still
    reads that one partition, but the subquery has a row of every retained day to go through.
    """
    if day is not None:
        return df.where(F.col(column) == F.lit(day))
    newest = (df if anchor is None else anchor).agg(F.max(column)).scalar()
    return df.where(F.col(column) == newest)
