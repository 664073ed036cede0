"""Token-ID matrices: documents packed into rows of equal length by best-fit decreasing.

A document longer than a row is cut into full rows and a remainder. The segments are then placed by
decreasing length, each into the open row with the least space that still holds it. A segment tree over
the amounts of free space, whose nodes know whether any row below them has that much, finds it in as many
steps as the length has bits.

Documents are packed with others of their task, `group_tokens` at a time: no shuffle, bounded memory, and
with some thousand rows to choose from little space is lost. Which documents meet depends on how the input
is split; that every token is stored once does not.

A matrix (block) of rows is one row of the result: its ids and the positions that restart at 0 in each
segment as unsigned 16-bit little-endian numbers row by row, and for each row the cumulative lengths of its
segments, their documents, and where in its document each segment starts.

Defined results
- A null list of ids, like an empty one, is a segment of length 0. Null ids of documents stay null.
- Space at a row's end holds the padding id; positions there are 0.
- Ties in length go by order of input; repeated rows are packed again. Empty tables: no rows.
- Other columns are dropped. Ids must fit 16 bits.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from headway.llm.shared import list_array, segments

BLOCKS = (
    "block_id long, n_rows int, row_length int, ids binary, positions binary, cu_seqlens array<array<int>>, "
    "doc_ids array<array<long>>, starts array<array<long>>"
)


# -- ids ---------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: Column, path: str, pattern: str) -> Column:
    """array<int> of byte-level ids of a text (null: empty) by a rank file."""

    @arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        one = encoding(path, pattern)
        ids = [np.array(one.encode_ordinary(t), np.int32) if t else np.zeros(0, np.int32) for t in texts.to_pylist()]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return list_array(flat, segments(np.array([len(x) for x in ids], np.int64)))

    return encode(text)


# -- packing -----------------------------------------------------------------------------


class FreeSpace:
    """Open rows by the space left in them, with the least sufficient one found by descent."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, row: int, space: int) -> None:
        self.rows[space].append(row)
        node = space + self.leaves
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """A row with the least space that is at least that much, and the space; it is closed."""
        node = least + self.leaves
        # Up, until there is something in the subtree to the right (or at the leaf itself).
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        space = node - self.leaves
        row = self.rows[space].pop()
        if not self.rows[space]:
            while node and not (node < self.leaves and (self.any[2 * node] or self.any[2 * node + 1])):
                self.any[node] = 0
                node >>= 1
        return row, space


def best_fit_decreasing(lengths: np.ndarray, length: int) -> list[list[int]]:
    """Segments (none longer than a row) of each row, in the order they were placed."""
    rows: list[list[int]] = []
    free = FreeSpace(length)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        if (found := free.take(n)) is None:
            row, space = len(rows), length
            rows.append([])
        else:
            row, space = found
        rows[row].append(i)
        free.put(row, space - n)
    return rows


def cut(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of the segments: full rows and a remainder of each document."""
    pieces = np.maximum(1, -(-lengths // length))
    doc = np.repeat(np.arange(len(lengths)), pieces)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
    return doc, start, np.minimum(lengths[doc] - start, length)


def pack_group(doc_ids: list, flat: np.ndarray, offsets: np.ndarray, length: int, pad: int) -> list[dict]:
    """Rows of a group of documents: ids, positions, cumulative lengths, documents and starts."""
    doc, start, size = cut(np.diff(offsets), length)
    out = []
    for row in best_fit_decreasing(size, length):
        ids, positions = np.full(length, pad, np.uint16), np.zeros(length, np.uint16)
        ends = segments(size[row])
        for s, low, high in zip(row, ends[:-1], ends[1:], strict=True):
            at = offsets[doc[s]] + start[s]
            ids[low:high] = flat[at : at + high - low]
            positions[low:high] = np.arange(high - low)
        out.append(
            {
                "ids": ids,
                "positions": positions,
                "cu_seqlens": ends.astype(np.int32).tolist(),
                "doc_ids": [doc_ids[doc[s]] for s in row],
                "starts": start[row].tolist(),
            }
        )
    return out


def pack(tokens: DataFrame, pad: int, length: int = 2048, group_tokens: int = 4_000_000, block_rows: int = 64,
         id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """Blocks of packed rows of all documents; see above for the columns.

    A longer document than group_tokens is a group of its own with whatever came before it.
    """
    schema = pa.schema(
        [("block_id", pa.int64()), ("n_rows", pa.int32()), ("row_length", pa.int32()), ("ids", pa.binary()), ("positions", pa.binary()),
         ("cu_seqlens", pa.list_(pa.list_(pa.int32()))), ("doc_ids", pa.list_(pa.list_(pa.int64()))), ("starts", pa.list_(pa.list_(pa.int64())))]
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 33
        held_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def blocks() -> Iterator[pa.RecordBatch]:
            nonlocal block, size
            offsets = segments(np.array([len(x) for x in held], np.int64))
            rows = pack_group(held_ids, np.concatenate(held), offsets, length, pad)
            for at in range(0, len(rows), block_rows):
                some = rows[at : at + block_rows]
                joined = {k: np.concatenate([r[k] for r in some]).astype("<u2").tobytes() for k in ("ids", "positions")}
                lists = {k: [r[k] for r in some] for k in ("cu_seqlens", "doc_ids", "starts")}
                one = {"block_id": block, "n_rows": len(some), "row_length": length} | joined | lists
                yield pa.RecordBatch.from_pylist([one], schema=schema)
                block += 1
            held_ids.clear()
            held.clear()
            size = 0

        for batch in batches:
            lists = batch.column("ids")
            ends = segments(np.array(lists.value_lengths().fill_null(0)))
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and (flat.min() < 0 or flat.max() > 65535):
                raise ValueError("ids must fit 16 bits")
            for i, (doc, low, high) in enumerate(zip(batch.column("id").to_pylist(), ends[:-1], ends[1:], strict=True)):
                held_ids.append(doc)
                held.append(flat[low:high].astype(np.uint16))
                size += high - low
                if size >= group_tokens:
                    yield from blocks()
        if held:
            yield from blocks()

    rows = tokens.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(packed, BLOCKS)


def rows_of(blocks: DataFrame) -> DataFrame:
    """One row per packed row: block_id, row, ids, positions (binary), cu_seqlens, doc_ids, starts."""
    each = blocks.select("*", F.posexplode(F.arrays_zip("cu_seqlens", "doc_ids", "starts")).alias("row", "lists"))
    part = lambda c: F.substring(F.col(c), F.col("row") * F.col("row_length") * 2 + 1, F.col("row_length") * 2).alias(c)
    return each.select("block_id", "row", part("ids"), part("positions"), "lists.cu_seqlens", "lists.doc_ids", "lists.starts")


def unpack(blocks: DataFrame) -> DataFrame:
    """The documents again: doc_id and token_ids. Ids of documents must not be null or repeat."""

    @arrow_udf("array<int>")
    def numbers(data: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x, "<u2").astype(np.int32) for x in data.to_pylist()], pa.list_(pa.int32()))

    each = rows_of(blocks).withColumn("n", numbers("ids"))
    cut_out = F.transform(
        F.sequence(F.lit(0), F.size("doc_ids") - 1),
        lambda i: F.struct(
            F.get("doc_ids", i).alias("doc_id"),
            F.get("starts", i).alias("start"),
            F.slice("n", F.get("cu_seqlens", i) + 1, F.get("cu_seqlens", i + 1) - F.get("cu_seqlens", i)).alias("ids"),
        ),
    )
    found = each.select(F.explode(cut_out).alias("s")).select("s.*")
    parts = F.array_sort(F.collect_list(F.struct("start", "ids")))
    return found.groupBy("doc_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("token_ids"))
