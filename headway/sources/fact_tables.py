"""Facts as bucketed, day-partitioned tables with a planned number of files.

The calendar multiplies a fact's rows as its last step, so how many files a day has is decided by how the
rows lie before that step. `plan_layout` takes the largest day off a roll-up's counts, before the fact
is made, and gives a day as many buckets as its bytes take files. `dealt` then lays the few rows there
are before the calendar out by bucket of the key, one bucket to a task, with the bucketing hash of
Spark's tables: after the calendar a task still holds one bucket, and writes one file for each of its
days. Where the buckets alone would leave cores idle, the days are dealt to slices, and a task holds one
bucket and one slice; a row goes to the slices that its service runs in. The multiplied rows are neither
shuffled nor sorted.

The tables are in the catalog with their buckets, so that later joins and groups on the key need no
exchange. Their folders are those of any table partitioned by day.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from headway.session import scratch_dir
from headway.sources.tables import PACKED, partition_values, unsorted_writes

FILE_BYTES = 128 * 1024 * 1024
SLICE, SLICES = "_slice", "_slices"


@dataclass(frozen=True)
class FactLayout:
    """Buckets of a key, and slices of the days that are written by different tasks."""

    key: str
    buckets: int
    slices: int = 1


def plan_layout(
    counts: DataFrame,
    key: str,
    day: str,
    rows: str,
    row_bytes: float,
    file_bytes: int = FILE_BYTES,
    tasks: int | None = None,
) -> FactLayout:
    """The layout of a fact with `rows` rows on `day`, as a roll-up has them in any number of parts.

    row_bytes: of a row as written. tasks: that should share the work; the session's parallelism by default.
    """
    per_day = counts.groupBy(day).agg(F.sum(rows).alias("rows"))
    found = per_day.agg(F.max("rows").alias("most"), F.count(F.lit(1)).alias("days")).first()
    buckets = max(1, math.ceil((found.most or 0) * row_bytes / file_bytes))
    tasks = tasks or counts.sparkSession.sparkContext.defaultParallelism
    return FactLayout(key, buckets, max(1, min(found.days, math.ceil(tasks / buckets))))


def dealt(rows: DataFrame, layout: FactLayout) -> DataFrame:
    """Rows once per slice, each bucket of each slice in a partition of its own, in the order of the key.

    The bucket is that of Spark's bucketed tables. A column SLICES names the slices that a row goes to, all by default.
    """
    slices = F.col(SLICES) if SLICES in rows.columns else F.sequence(F.lit(0), F.lit(layout.slices - 1))
    sliced = rows.withColumn(SLICE, F.explode(slices)).drop(SLICES)
    place = F.col(SLICE) * layout.buckets + F.pmod(F.hash(layout.key), F.lit(layout.buckets))
    partitions = layout.buckets * layout.slices
    return sliced.repartitionById(partitions, place.cast("int")).sortWithinPartitions(layout.key)


def on_days(rows: DataFrame, days: DataFrame, layout: FactLayout | None = None) -> DataFrame:
    """Rows once per day of their service; with a layout, laid out by it first.

    Broadcasting the days, where Spark finds them small enough, keeps the rows where they lie. Beyond that
    the join shuffles by service, and a day has files of more tasks than planned.
    """
    if layout is None:
        return rows.join(days, "service_id")
    slice_of = F.pmod(F.datediff("service_date", F.lit("1970-01-01").cast("date")), F.lit(layout.slices))
    sliced = days.withColumn(SLICE, slice_of)
    if layout.slices > 1:
        # Written: Spark then knows that the services are few, and broadcasts them.
        path = scratch_dir(days.sparkSession, "service-slices")
        sliced.groupBy("service_id").agg(F.collect_set(SLICE).alias(SLICES)).write.parquet(path)
        rows = rows.join(days.sparkSession.read.parquet(path), "service_id")
    return dealt(rows, layout).join(sliced, ["service_id", SLICE]).drop(SLICE)


def write_fact(df: DataFrame, name: str, path: str, day: str, layout: FactLayout) -> None:
    """Write a fact, partitioned by day and bucketed, and enter it in the catalog as `name`.

    Has the session keep the files of a task open, unless it says how many: rows are then written as they come.
    """
    spark = df.sparkSession
    unsorted_writes(spark)
    (
        df.write.mode("overwrite")
        .options(**PACKED)
        .option("partitionOverwriteMode", "static")
        .option("path", path)
        .partitionBy(day)
        .bucketBy(layout.buckets, layout.key)
        .saveAsTable(name)
    )
    # For sessions to come: the files do not say how they are bucketed.
    spark.range(1).select(
        F.lit(layout.key).alias("key"), F.lit(layout.buckets).alias("buckets"), F.lit(day).alias("day")
    ).write.mode("overwrite").parquet(_layout_path(path))


def open_fact(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A fact that `write_fact` wrote, in the catalog of this session as `name`."""
    layout = _layout(spark, path)
    if layout is None:
        raise ValueError(f"{path} has not been written with a layout")
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"drop table if exists {name}")
    spark.sql(
        f"create table {name} ({columns}) using parquet partitioned by (`{layout.day}`) "
        f"clustered by (`{layout.key}`) into {layout.buckets} buckets location '{path}'"
    )
    if partition_values(spark, path, layout.day):
        spark.sql(f"alter table {name} recover partitions")
    return spark.table(name)


def is_laid_out(spark: SparkSession, path: str) -> bool:
    return _layout(spark, path) is not None


def _layout(spark: SparkSession, path: str) -> Row | None:
    try:
        return spark.read.schema("key string, buckets int, day string").parquet(_layout_path(path)).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _layout_path(path: str) -> str:
    return f"{path.rstrip('/')}.layout"
