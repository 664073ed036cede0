"""Order-independent digests of rows: by hash bucket of a key, which part of a table has changed; over a
group, in a form that other SQL engines compute as well, whether two stores hold the same rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

#: Between the values of a row, and in place of NULL, in the text that portable digests are taken of.
SEPARATOR, NULL_TEXT = "\x1f", "\x1e"
#: Steps of a number with a fraction that a portable digest tells apart.
FRACTION = 1_000_000


@dataclass(frozen=True)
class Digest:
    """Number of rows, and two exclusive-ors of independent 64-bit hashes of them."""

    rows: int = 0
    first: int = 0
    second: int = 0

    def __add__(self, other: Digest) -> Digest:
        return Digest(self.rows + other.rows, self.first ^ other.first, self.second ^ other.second)


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key. Where `a` divides `b`, bucket i of `a` is those of `b` that leave i."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """64-bit hash of the columns. Which of them are NULL is part of it: the hash itself skips NULL."""
    missing = " + ".join(f"if(`{c}` is null, {1 << i}L, 0L)" for i, c in enumerate(columns))
    return F.xxhash64(F.lit(seed), F.expr(missing), *columns)


def bucket_digests(df: DataFrame, key: str, columns: Sequence[str], buckets: int) -> dict[int, Digest]:
    """Digest of `key` and `columns` for each bucket that has rows.

    Combined map-side: a task hands on one row per bucket, whatever it read, and the driver sees
    one per bucket. At most 62 columns.
    """
    found = _hashed(df, key, columns, buckets).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("first").alias("first"), F.bit_xor("second").alias("second")
    )
    return {r.bucket: Digest(r.rows, r.first, r.second) for r in found.collect()}


def unique_bucket_digests(
    df: DataFrame, key: str, columns: Sequence[str], buckets: int
) -> tuple[dict[int, Digest], bool]:
    """The same, and whether no key but NULL repeats; one shuffle, of keys and hashes."""
    by_key = _hashed(df, key, columns, buckets).groupBy("bucket", key).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("first").alias("first"), F.bit_xor("second").alias("second")
    )
    found = by_key.groupBy("bucket").agg(
        F.sum("rows").alias("rows"),
        F.bit_xor("first").alias("first"),
        F.bit_xor("second").alias("second"),
        F.max(F.when(F.col(key).isNotNull(), F.col("rows"))).alias("most"),
    )
    rows = found.collect()
    return {r.bucket: Digest(r.rows, r.first, r.second) for r in rows}, all((r.most or 0) <= 1 for r in rows)


def _hashed(df: DataFrame, key: str, columns: Sequence[str], buckets: int) -> DataFrame:
    hashed = [key, *columns]
    return df.select(
        key,
        bucket_of(key, buckets).alias("bucket"),
        row_hash(hashed, 1).alias("first"),
        row_hash(hashed, 2).alias("second"),
    )


def folded(digests: dict[int, Digest], buckets: int) -> dict[int, Digest]:
    """The digests of fewer buckets, whose number divides the old one."""
    out: dict[int, Digest] = {}
    for bucket, digest in digests.items():
        out[bucket % buckets] = out.get(bucket % buckets, Digest()) + digest
    return out


def portable_digest(schema: StructType) -> Column:
    """Aggregate: the sum, as text, of 60 bits of each row's MD5. Columns are text, whole numbers,
    booleans or numbers with a fraction, of which millionths count, as engines print these differently.

    Rows that repeat count each time. A sum is combined map-side: one number a group and task is shuffled.
    """
    values = [
        F.floor(F.col(f"`{f.name}`") * FRACTION) if isinstance(f.dataType, DoubleType) else F.col(f"`{f.name}`")
        for f in schema
    ]
    row = F.concat_ws(SEPARATOR, *(F.coalesce(v.cast("string"), F.lit(NULL_TEXT)) for v in values))
    bits = F.conv(F.substring(F.md5(row), 1, 15), 16, 10)
    return F.sum(bits.cast("decimal(38,0)")).cast("string")
