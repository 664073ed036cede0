"""Join of the two sources of one entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from headway.schemas import PARTITION_COLUMN


@dataclass(frozen=True)
class MergeSpec:
    """How the API rows and the feed rows of `entity` become one table."""

    entity: str
    feed_key: str
    exclude: Sequence[str] = ()
    rename: Mapping[str, str] = field(default_factory=dict)


# The merged tables, the columns they leave out and their new names.
MERGES = {
    "routes": MergeSpec(
        "routes", "route_id", exclude=("color", "text_color", "id", "short_name", "long_name")
    ),
    "stops": MergeSpec(
        "stops",
        "stop_id",
        exclude=("id", "lat", "lon", "short_name", "long_name", "tts_name", "stop_name_new"),
        rename={"stop_lat": "stop_latitude", "stop_lon": "stop_longitude"},
    ),
}


def merge_sources(
    endpoint: DataFrame,
    feed: DataFrame,
    spec: MergeSpec,
    match_partition: bool = True,
    endpoint_has_copies: bool = True,
) -> DataFrame:
    """Inner join of API and feed rows on the entity id; the API's column wins a name clash.

    `match_partition` also requires the same extraction day. Without it every API
    row meets the feed rows of all retained days, and keeps its own day.

    Copies go before the join: two sets without copies join to a set without
    copies, so this equals removing them afterwards, while a row held k times on
    one side and m times on the other never becomes k * m rows. A caller whose API
    rows are known to be free of copies, as staged rows are, saves their shuffle; the
    feed's rows can become copies here, when their clashing columns are left out.
    """
    match_day = match_partition and PARTITION_COLUMN in feed.columns
    feed_day = f"_feed_{PARTITION_COLUMN}"
    added = [F.col(c) for c in feed.columns if c not in endpoint.columns]
    if match_day:
        added.append(F.col(PARTITION_COLUMN).alias(feed_day))
    left = endpoint.dropDuplicates() if endpoint_has_copies else endpoint
    right = feed.select(added).dropDuplicates()

    same_id = _as_key(left, "id", right, spec.feed_key) == right[spec.feed_key]
    if match_day:
        same_id = same_id & (left[PARTITION_COLUMN] == right[feed_day])
    return (
        left.join(right, same_id, "inner")
        .drop(feed_day, *spec.exclude)
        .withColumnsRenamed(dict(spec.rename))
    )


def _as_key(left: DataFrame, key: str, right: DataFrame, other: str):
    """The text id of the API in the type of the feed's id; '010101' matches 10101."""
    c = left[key]
    if isinstance(right.schema[other].dataType, LongType):
        return c.try_cast("bigint")
    return c
