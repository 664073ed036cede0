"""Missing values, sentinel text, nested cells and JSON text.

Every operator is one narrow `select` over the whole frame: no shuffle, no Python
in the tasks, and one projection however many columns it touches.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    MapType,
    StringType,
    StructType,
)

# What staging writes for missing data, and how views print it.
MISSING_NUMBER = 0.0
MISSING_TEXT = "UNKNOWN"
STOP_SENTINELS = (("NaN", "N/A"), ("UNKNOWN", "N/A"))
NAN_SENTINEL = (("NaN", "N/A"),)


def fill_missing(df: DataFrame) -> DataFrame:
    """NaN or NULL becomes 0 in floating columns, NULL becomes UNKNOWN in text; others stay."""
    filled = {}
    for field in df.schema:
        c = F.col(_quoted(field.name))
        if isinstance(field.dataType, (DoubleType, FloatType)):
            zero = F.lit(MISSING_NUMBER).cast(field.dataType)
            filled[field.name] = F.coalesce(F.nanvl(c, zero), zero)
        elif isinstance(field.dataType, StringType):
            filled[field.name] = F.coalesce(c, F.lit(MISSING_TEXT))
    return _with(df, filled)


def normalise_sentinels(
    df: DataFrame,
    columns: Iterable[str],
    pairs: Iterable[tuple[str, str]] = STOP_SENTINELS,
    exact: bool = False,
) -> DataFrame:
    """Replace sentinel text in `columns`, one pair after the other.

    By default a sentinel is replaced wherever it occurs inside the value;
    `exact` replaces only values that equal it.
    """
    replaced = {}
    for name in columns:
        c = F.col(_quoted(name))
        for old, new in pairs:
            if exact:
                c = F.when(c == old, F.lit(new)).otherwise(c)
            else:
                c = F.replace(c, F.lit(old), F.lit(new))
        replaced[name] = c
    return _with(df, replaced)


def json_to_array(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """JSON array text to ARRAY<STRING>, for those of `columns` that exist. Bad JSON gives NULL."""
    present = [c for c in columns if c in df.columns]
    return _with(df, {c: F.from_json(F.col(_quoted(c)), ArrayType(StringType())) for c in present})


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct, array and map cells to JSON text; NULL stays NULL and non-ASCII text stays as it is."""
    nested = [f.name for f in df.schema if _is_nested(f.dataType)]
    return _with(df, {c: F.to_json(F.col(_quoted(c))) for c in nested})


def flatten_structs(df: DataFrame) -> DataFrame:
    """Struct columns to one column per leaf, named by its dotted path."""
    leaves: list[Column] = []

    def walk(schema: StructType, path: tuple[str, ...]) -> None:
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                walk(field.dataType, here)
            else:
                leaves.append(F.col(".".join(map(_quoted, here))).alias(".".join(here)))

    walk(df.schema, ())
    return df.select(leaves)


def _is_nested(data_type: DataType) -> bool:
    return isinstance(data_type, (StructType, ArrayType, MapType))


def _with(df: DataFrame, replaced: Mapping[str, Column]) -> DataFrame:
    return df.select(
        [replaced[c].alias(c) if c in replaced else F.col(_quoted(c)) for c in df.columns]
    )


def _quoted(name: str) -> str:
    return f"`{name}`"
