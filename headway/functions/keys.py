"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token and separator of the widely used SQL surrogate-key
# convention, so keys match tables that were built with it.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 over the text of the columns; NULL has its own token, so ('a', NULL) != (NULL, 'a')."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in columns
    ]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
