"""What the operators share: written intermediate tables, table access, batch helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import scratch_dir


#: Rows of a batch that goes to a Python worker. Texts are long: at Spark's 10,000 a batch comes to tens of
#: megabytes, several times over in the worker. The size of batches changes no result.
BATCH_ROWS = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Has the session send texts to Python workers in small batches, unless it has smaller ones."""
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """df as a table written to the shared folder and read again.

    That cuts the lineage in a way that outlives executors, computes an expensive
    pass once for all its readers, and lets Spark judge joins by the written size.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of an id written as text, modulo divisor: decides what is held out. Null: null."""
    return F.crc32(id_col.cast("string")) % divisor


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def segments(counts: np.ndarray) -> np.ndarray:
    """Offsets of consecutive segments of the given lengths: one more than there are segments."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def utf8(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end, and the offset of each text in them (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one come to about size bytes (one text at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, end - start)
            start = end


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow lists over a flat array."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
