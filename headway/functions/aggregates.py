"""Aggregate expressions shared by the analyses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_text(value: Column, separator: str) -> Column:
    """Distinct non-NULL values in order, joined; NULL where there is none.

    collect_set merges map-side, so a hot group ships only its distinct values.
    """
    values = F.collect_set(value)
    return F.when(F.size(values) > 0, F.array_join(F.sort_array(values), separator))
