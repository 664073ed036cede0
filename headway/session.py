"""Spark session for tests, benchmarks and stand-alone runs, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"

SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def build_session(
    app_name: str = "headway",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with the settings the plans rely on.

    shuffle_bytes: size of the largest shuffle to expect, such as the stop times of
    one day. It sets how many partitions a shuffle starts with, so that one fits in
    memory; adaptive execution joins those that turn out small, and aims at their
    advisory size rather than at one for every core, so that files come out whole.
    It changes partition counts only, never rows.

    Adaptive execution does three jobs here: it turns a join into a broadcast
    join only once the measured size of a side allows it, it splits skewed join
    partitions, and it sizes the partitions of REBALANCE writes. All three are
    Spark defaults; they are spelled out because the plans depend on them.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        # Sizes of parquet scans are those of compressed files; judge broadcasts by what
        # the rows take up in memory.
        .config("spark.sql.sources.fileCompressionFactor", "4.0")
        # A task keeps a writer open for each of so many days: more than a feed plans ahead, so
        # that rows which the calendar has just multiplied are not sorted before they are written.
        .config("spark.sql.maxConcurrentOutputFileWriters", "400")
    )
    if shuffle_bytes:
        partitions = max(200, shuffle_bytes // SHUFFLE_PARTITION_BYTES)
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
        ).config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path in the shared folder of the cluster.

    That is spark.checkpoint.dir or, where it is unset, the warehouse. A warehouse
    left at its default is a folder of the driver's machine; on a cluster that is
    refused, since each executor would write to its own disk. A folder named in
    spark.checkpoint.dir is taken as shared, whatever its scheme: it may be mounted.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        root = spark.conf.get(WAREHOUSE_DIR)
        on_one_machine = spark.sparkContext.master.startswith("local")
        if root.startswith(("file:", "/")) and not on_one_machine:
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
