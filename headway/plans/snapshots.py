"""Kept history of the dimensions, on plain parquet, brought up to date by changed buckets.

Layout of one snapshot table
    versions/version=<run>/state=open/bucket=<b>/     open versions of a bucket that the run rewrote
    versions/version=<run>/state=closed/bucket=<b>/   the versions the run closed
    commits/version=<run>/                            what the run changed, written last

Keys are dealt to buckets by hash. A run takes an order-independent digest of each bucket of the
dimension, in one pass without shuffle, and compares it with the one it was last brought up to date
with. Only the buckets that differ are read, joined and written; the open versions of the others stay
in the folder of the run that wrote them. A run of an unchanged dimension writes one marker row.

A commit holds a marker row and, for each bucket it rewrote, the bucket's new digest. The manifest, that
is the newest row of each bucket, tells readers which folders are in force. A run never overwrites what
it reads and never rewrites closed history; one that died half way is invisible.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.operators.digests import (
    Digest,
    bucket_digests,
    bucket_of,
    folded,
    unique_bucket_digests,
)
from headway.operators.history import (
    SNAPSHOTS,
    VALID_TO,
    SnapshotSpec,
    apply_changes,
    as_of,
    first_snapshot,
    with_ids,
    without_ids,
)
from headway.operators.quality import repeated_values
from headway.sources.tables import PACKED, in_parallel

STATE = "state"
VERSION = "version"
BUCKET = "bucket"
COMMIT = "bucket int, buckets int, rows bigint, first bigint, second bigint, closes boolean"
COMMIT_COLUMNS = [c.split()[0] for c in COMMIT.split(", ")]

#: Rows that a bucket is meant for. There are as many buckets as that takes, a power of two, up to MOST_BUCKETS.
ROWS_PER_BUCKET = 1_000_000
#: Digests the driver sees at most.
MOST_BUCKETS = 4_096
#: Buckets are dealt anew, with a full rewrite, once they hold so many times more.
OUTGROWN = 4


@dataclass(frozen=True)
class Manifest:
    """What is in force: the last committed run, and for each bucket its digest and the run that wrote it."""

    last: str
    buckets: int
    digests: dict[int, Digest]
    written: dict[int, str]
    closing: list[str]


def take_snapshot(
    spark: SparkSession,
    root: str,
    spec: SnapshotSpec,
    current: DataFrame,
    run_at: dt.datetime,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """Bring the kept history of one dimension up to date with `current`.

    A run that is already committed is done: taking it again changes nothing. An older one is
    refused, and so is a dimension that repeats a key, before anything is written: each of
    the rows would open versions of its own, more with every run. A bucket whose digest is
    as it was when its keys were found unique is not looked through again.
    """
    path = f"{root}/{spec.name}"
    held = _manifest(spark, path)
    started = _stamp(run_at)
    if held is not None and started == held.last.split("-")[0]:
        return
    if held is not None and started < held.last.split("-")[0]:
        raise ValueError(f"{spec.name} already has a snapshot taken after {run_at}")

    rows = current.select(spec.columns)
    repeats = f"{spec.name}: {spec.key} repeats in the rows to snapshot"
    if held is None:
        # All keys are new and have to be looked through: the digest is taken from the same pass.
        found, unique = unique_bucket_digests(rows, spec.key, spec.check, MOST_BUCKETS)
        if not unique:
            raise ValueError(repeats)
    else:
        found = bucket_digests(rows, spec.key, spec.check, MOST_BUCKETS)
    total = sum(d.rows for d in found.values())
    buckets = _buckets_for(total, rows_per_bucket)
    outgrown = held is not None and total > OUTGROWN * held.buckets * rows_per_bucket and buckets > held.buckets
    if held is not None and not outgrown:
        buckets = held.buckets
    digests = folded(found, buckets)
    version = f"{started}-{uuid.uuid4().hex[:8]}"
    if held is None or outgrown:
        changed = set(digests)
    else:
        changed = {b for b, d in digests.items() if d != held.digests.get(b)}
        if not changed:
            _commit(spark, path, version, buckets, {}, closes=False)
            return
        if len(changed) < len(digests):
            rows = rows.where(bucket_of(spec.key, buckets).isin(sorted(changed)))

    if held is not None and not repeated_values(rows, spec.key).isEmpty():
        raise ValueError(repeats)
    stamp = F.lit(run_at).cast("timestamp")
    before = None if held is None else _open_rows(spark, path, held, None if outgrown else changed)
    if before is None:
        after = first_snapshot(rows, spec.key, stamp)
    else:
        after = apply_changes(before, rows, spec.key, spec.check, stamp)
    closes = _write(after, f"{path}/versions/{VERSION}={version}", spec.key, buckets)
    if outgrown:
        # Keys that the dimension no longer has came along to buckets of their own.
        moved = spark.read.parquet(f"{path}/versions/{VERSION}={version}/{STATE}=open")
        digests = {b: digests.get(b, Digest()) for (b,) in moved.select(BUCKET).distinct().collect()}
        changed = set(digests)
    _commit(spark, path, version, buckets, {b: digests[b] for b in changed}, closes)


def read_snapshot(spark: SparkSession, root: str, spec: SnapshotSpec) -> DataFrame:
    """The whole history of one dimension as of its last committed run."""
    return _history(spark, root, spec, None)


def read_as_of(spark: SparkSession, root: str, spec: SnapshotSpec, at: dt.datetime) -> DataFrame:
    """The versions valid at `at`.

    Versions that a run closed end at the time of the run, which its folder is named by: runs up to
    `at` are left out by a partition filter, so that no version that had ended by then is read.
    """
    return as_of(_history(spark, root, spec, at), F.lit(at).cast("timestamp"))


def snapshot_dimensions(
    spark: SparkSession, root: str, dimensions: dict[str, DataFrame], run_at: dt.datetime
) -> None:
    """Snapshot every tracked dimension that is given."""
    in_parallel(
        partial(take_snapshot, spark, root, spec, dimensions[name], run_at)
        for name, spec in SNAPSHOTS.items()
        if name in dimensions
    )


def _stamp(run_at: dt.datetime) -> str:
    """Name of a run's time, in the order of time."""
    if run_at.tzinfo is not None:
        run_at = run_at.astimezone(dt.timezone.utc)
    return f"v{run_at:%Y%m%d%H%M%S%f}"


def _buckets_for(rows: int, rows_per_bucket: int) -> int:
    buckets = 1
    while buckets < MOST_BUCKETS and buckets * rows_per_bucket < rows:
        buckets *= 2
    return buckets


def _manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest row of each bucket and of the marker; None before the first commit.

    The driver sees a row per bucket and the names of the runs that closed versions.
    """
    try:
        commits = spark.read.schema(COMMIT).parquet(f"{path}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # More buckets are newer: their number only grows.
    newest = F.max(F.struct("buckets", VERSION, "rows", "first", "second")).alias("newest")
    closing = F.collect_set(F.when(F.col("closes"), F.col(VERSION))).alias("closing")
    found = {r.bucket: r for r in commits.groupBy(BUCKET).agg(newest, closing).collect()}
    if not found:
        return None
    marker = found.pop(None)
    in_force = {b: r.newest for b, r in found.items() if r.newest.buckets == marker.newest.buckets}
    return Manifest(
        last=marker.newest.version,
        buckets=marker.newest.buckets,
        digests={b: Digest(n.rows, n.first, n.second) for b, n in in_force.items()},
        written={b: n.version for b, n in in_force.items()},
        closing=sorted(marker.closing),
    )


def _read(spark: SparkSession, path: str, folders: Iterable[str]) -> DataFrame:
    return spark.read.option("basePath", f"{path}/versions").parquet(*(f"{path}/versions/{f}" for f in folders))


def _open_rows(spark: SparkSession, path: str, held: Manifest, buckets: Collection[int] | None) -> DataFrame | None:
    """The open versions of the given buckets (None: of all); None where no run has written any."""
    folders = [
        f"{VERSION}={version}/{STATE}=open/{BUCKET}={b}"
        for b, version in sorted(held.written.items())
        if buckets is None or b in buckets
    ]
    return _read(spark, path, folders).drop(STATE, VERSION, BUCKET) if folders else None


def _history(spark: SparkSession, root: str, spec: SnapshotSpec, at: dt.datetime | None) -> DataFrame:
    path = f"{root}/{spec.name}"
    held = _manifest(spark, path)
    if held is None:
        raise ValueError(f"{spec.name} has no snapshot yet under {root}")
    history = _open_rows(spark, path, held, None)
    if history is None:
        raise ValueError(f"{spec.name} has had no rows yet under {root}")
    if held.closing:
        closed = _read(spark, path, (f"{VERSION}={v}/{STATE}=closed" for v in held.closing))
        if at is not None:
            # A run at `at` itself closed what was valid before `at`: its versions are out too.
            closed = closed.where(F.col(VERSION) >= _stamp(at + dt.timedelta(microseconds=1)))
        history = history.unionByName(closed.drop(STATE, VERSION, BUCKET))
    return history


def _write(after: DataFrame, path: str, key: str, buckets: int) -> bool:
    """Write the versions of a run by state and bucket; tells whether any of them is closed."""
    state = F.when(F.col(VALID_TO).isNull(), "open").otherwise("closed")
    closed = Observation()
    rows = after.withColumn(STATE, state).withColumn(BUCKET, bucket_of(key, buckets))
    rows = rows.observe(closed, F.count(F.when(F.col(STATE) == "closed", 1)).alias("rows"))
    if buckets > 1:
        # A bucket is a few large files, not one from every task. Ids are made after the shuffle.
        rows = with_ids(without_ids(rows, key).hint("rebalance", STATE, BUCKET), key)
    rows.write.options(**PACKED).partitionBy(STATE, BUCKET).parquet(path)
    return closed.get["rows"] > 0


def _commit(
    spark: SparkSession, path: str, version: str, buckets: int, digests: dict[int, Digest], closes: bool
) -> None:
    """Make a run visible: one marker row, and one for each bucket the run rewrote."""
    values = [f"(cast(null as int), {buckets}, {', '.join(['cast(null as bigint)'] * 3)}, {str(closes).lower()})"]
    values += [f"({b}, {buckets}, {d.rows}L, {d.first}L, {d.second}L, false)" for b, d in sorted(digests.items())]
    # Inline rows: a table of the driver's, which no Python worker has to make.
    rows = spark.sql(f"select * from values {', '.join(values)}").toDF(*COMMIT_COLUMNS)
    rows.coalesce(1).write.parquet(f"{path}/commits/{VERSION}={version}")
