"""Slowly changing dimension history (type 2): which version of a row was valid when."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.schemas import INGESTED_AT

# The bookkeeping columns of a snapshot table.
VERSION_ID = "dbt_scd_id"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"


@dataclass(frozen=True)
class SnapshotSpec:
    """A dimension whose history is kept: its key and the columns whose change makes a version."""

    name: str
    key: str
    check: Sequence[str]

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.check, INGESTED_AT]


# The tracked dimensions and the columns compared.
SNAPSHOTS = {
    "dim_line": SnapshotSpec(
        "snapshot_dim_line",
        "route_id",
        (
            "route_long_name", "route_short_name", "route_type", "route_color",
            "route_text_color", "line_id", "line_long_name", "line_short_name", "line_type",
            "agency_id", "tts_name", "circular", "school",
        ),
    ),
    "dim_stop": SnapshotSpec(
        "snapshot_dim_stop",
        "stop_id",
        (
            "stop_name", "stop_latitude", "stop_longitude", "municipality_id",
            "municipality_name", "region_id", "region_name", "near_school",
        ),
    ),
    "dim_trip": SnapshotSpec(
        "snapshot_dim_trip",
        "trip_id",
        ("direction", "route_id", "service_id", "trip_headsign", "pattern_id", "shape_id"),
    ),
}


def version_id(key: Column, valid_from: Column) -> Column:
    """Identifier of one version of one key."""
    stamp = F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", key.cast("string"), stamp))


def without_ids(rows: DataFrame, key: str) -> DataFrame:
    """Versions for a shuffle: an id, a hash in text, is half of a row. NULL stands for one that `with_ids` makes
    again; any other is kept, in a struct."""
    made = version_id(F.col(key), F.col(VALID_FROM))
    return rows.withColumn(VERSION_ID, F.when(~F.col(VERSION_ID).eqNullSafe(made), F.struct(VERSION_ID)))


def with_ids(rows: DataFrame, key: str) -> DataFrame:
    made = version_id(F.col(key), F.col(VALID_FROM))
    kept = F.col(f"{VERSION_ID}.{VERSION_ID}")
    return rows.withColumn(VERSION_ID, F.when(F.col(VERSION_ID).isNull(), made).otherwise(kept))


def first_snapshot(current: DataFrame, key: str, run_at: Column) -> DataFrame:
    """History of a dimension seen for the first time: every row is an open version."""
    return current.select(
        "*",
        version_id(F.col(key), run_at).alias(VERSION_ID),
        run_at.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
    )


def apply_changes(
    open_rows: DataFrame, current: DataFrame, key: str, check: Sequence[str], run_at: Column
) -> DataFrame:
    """Bring the open versions up to date with `current`.

    A new key opens a version. A change of a checked column, NULL included, closes
    the open version at `run_at` and opens another. An unchanged key keeps its
    version, and so does a key that `current` no longer has.

    One full outer join on the key yields both rows of a change at once, so each
    side is shuffled once however the key fared. `key` must be unique in `current`:
    `take_snapshot` refuses a dimension where it is not. Closed versions among the rows
    held meet no key and come out as they are.
    """
    columns = current.columns
    open_rows = without_ids(open_rows, key)
    # As text: an expression a column costs the driver more than the join of a small dimension.
    held = open_rows.selectExpr(
        f"struct({_listed([*columns, VERSION_ID, VALID_FROM, VALID_TO])}) held",
        f"`{key}` _key",
        f"{VALID_TO} is null _open",
    )
    seen = current.selectExpr(f"struct({_listed(columns)}) seen", f"`{key}` _key", "true _open")
    changed = " or ".join(f"not (held.`{c}` <=> seen.`{c}`)" for c in check) or "false"
    opened = F.struct(
        "seen.*",
        F.lit(None).cast(f"struct<{VERSION_ID}:string>").alias(VERSION_ID),
        run_at.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
    )
    closed = F.col("held").withField(VALID_TO, run_at)
    versions = (
        F.when(F.col("held").isNull(), F.array(opened))
        .when(F.col("seen").isNotNull() & F.expr(changed), F.array(closed, opened))
        .otherwise(F.array(F.col("held")))
    )
    joined = held.join(seen, ["_key", "_open"], "full_outer").select(F.explode(versions).alias("version"))
    return with_ids(joined.select("version.*"), key)


def _listed(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def scd2(
    history: DataFrame, current: DataFrame, key: str, check: Sequence[str], run_at: Column
) -> DataFrame:
    """The whole history after one more snapshot, reading it once."""
    return apply_changes(history, current, key, check, run_at)


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The versions valid at `at`: from their start on, up to but not including their end."""
    return history.where(
        (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (at < F.col(VALID_TO)))
    )
