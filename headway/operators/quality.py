"""Data-quality checks: missing values, repeated values, schema contracts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


REPORT = "column_name string, check_name string, failures bigint"


class ContractViolation(ValueError):
    """A table does not have the columns and types its contract promises."""


def not_null_report(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row per column with the number of rows where it is NULL; one pass for all columns."""
    columns = list(columns)
    counted = df.select(F.count(F.lit(1)).alias("_rows"), *(F.count(c).alias(c) for c in columns))
    missing = counted.select([(F.col("_rows") - F.col(c)).alias(c) for c in columns])
    return missing.unpivot([], columns, "column_name", "failures").select(
        "column_name", F.lit("not_null").alias("check_name"), "failures"
    )


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values of `column` that occur more than once, with their count; NULL is not a value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def first_look(df: DataFrame, not_null: Sequence[str], unique: Sequence[str]) -> DataFrame:
    """One row: how many rows have a NULL in a column of `not_null`, and for each column of `unique` how many
    values and how many different 64-bit hashes of values it has.

    One pass for all columns of both kinds. Spark expands a row into one entry per column that must not
    repeat, numbered, with the hash only, removes copies of these map-side and shuffles them once,
    some twenty bytes a value whatever the columns hold. The count of NULLs rides along.
    """
    kinds = dict(df.dtypes)
    missing = " or ".join(f"`{c}` is null" for c in not_null) or "false"
    counts = [F.count(F.when(F.expr(missing), 1)).alias("missing")]
    for i, c in enumerate(unique):
        hashed = F.when(F.col(c).isNotNull(), _hash_of(c, kinds[c]))
        counts += [F.count(c).alias(f"values_{i}"), F.count_distinct(hashed).alias(f"hashes_{i}")]
    return df.agg(*counts)


def check_columns(
    df: DataFrame, not_null: Iterable[str], unique: Iterable[str]
) -> list[tuple[str, str, int]]:
    """(column, check, failures): rows that are NULL, and values that occur more than once.

    A sound table is passed over once, for all columns together: `first_look`. Equal values have equal
    hashes, so a column with as many hashes as values repeats none. Only a column with fewer is grouped
    by value, as different values may share a hash, and only where NULLs were seen are they counted by
    column.
    """
    not_null, unique = list(not_null), list(unique)
    if not not_null and not unique:
        return []
    found = first_look(df, not_null, unique).first()
    report = [(c, "not_null", 0) for c in not_null]
    if found.missing:
        nulls = {r.column_name: r.failures for r in not_null_report(df, not_null).collect()}
        report = [(c, "not_null", nulls[c]) for c in not_null]
    for i, c in enumerate(unique):
        suspect = found[f"hashes_{i}"] < found[f"values_{i}"]
        report.append((c, "unique", repeated_values(df, c).count() if suspect else 0))
    return report


def _hash_of(column: str, kind: str) -> Column:
    """Equal values have equal hashes: zero has two signs."""
    value = F.col(column)
    if kind in ("double", "float"):
        value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
    return F.xxhash64(value)


def unique_report(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row per column with the number of values that occur more than once; one pass for all columns."""
    return _as_report(df, check_columns(df, [], columns))


def check_report(df: DataFrame, not_null: Iterable[str], unique: Iterable[str]) -> DataFrame:
    """One row per column and check with the number of failures; see `check_columns`."""
    return _as_report(df, check_columns(df, not_null, unique))


def _as_report(df: DataFrame, rows: list[tuple[str, str, int]]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, REPORT)


def contract_violations(schema: StructType, contract: StructType) -> list[tuple[str, str, str]]:
    """(column, promised type, found type) for each difference; an absent side reads `missing`."""
    found = {f.name: f.dataType.simpleString() for f in schema}
    promised = {f.name: f.dataType.simpleString() for f in contract}
    return [
        (name, promised.get(name, "missing"), found.get(name, "missing"))
        for name in [*promised, *(n for n in found if n not in promised)]
        if promised.get(name) != found.get(name)
    ]


def enforce_contract(df: DataFrame, contract: StructType, table: str) -> DataFrame:
    """`df` with its columns in contract order; raises before anything is read or written."""
    problems = contract_violations(df.schema, contract)
    if problems:
        listed = "; ".join(f"{name}: promised {p}, found {f}" for name, p, f in problems)
        raise ContractViolation(f"{table} breaks its contract: {listed}")
    return df.select(contract.fieldNames())
