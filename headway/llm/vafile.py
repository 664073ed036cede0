"""Exact top-k search by inner product over vector-approximation files.

A vector-approximation file holds a coarse cell of each component beside the exact vectors. A scan
of the cells bounds every score from above; exact vectors are then read in the order of that bound,
until the k-th score found is above the bound of all vectors not yet read.

Defined results
- Rows with a null id or vector, or a null or non-finite component, take no part.
- A row is no candidate of a query with its own id. Equal scores go to the smaller id.
- Vectors of another length than the query's are no candidates of it.
- A repeated row is a candidate as often as it occurs; a repeated query is answered once.
- Fewer candidates than k: all of them. Empty tables: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.shared import settle

BLOCK = 4096
FILE = (
    "dim int, part int, ids binary, low binary, width binary, cells binary, exact binary"
)
FOUND = "query_id long, query_key long, vec_id long, score long"


def integer_vector(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component; null if the vector can't take part."""
    usable = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(usable, scaled)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim).astype(np.int64)


def build_file(vectors: DataFrame, id_col: str, vector_col: str, bits: int, parts: int) -> DataFrame:
    """Blocks of a vector-approximation file, each of one part: ids, cells and exact vectors.

    A cell is the component's place among 2^bits equal steps over its range in the block.
    """

    def block(dim: int, part: int, ids: np.ndarray, exact: np.ndarray) -> dict:
        low = exact.min(axis=0) if dim else np.zeros(0, np.int64)
        high = exact.max(axis=0) if dim else low
        width = -(-(high - low + 1) // (1 << bits))
        cells = (exact - low) // np.maximum(width, 1)
        stored = {"ids": ids, "low": low, "width": width, "cells": cells.astype(np.uint16), "exact": exact}
        return {"dim": dim, "part": part} | {k: v.tobytes() for k, v in stored.items()}

    def build(rows: pa.Table) -> pa.Table:
        dim, part = rows.column("dim")[0].as_py(), rows.column("part")[0].as_py()
        ids = rows.column(id_col).to_numpy()
        exact = _matrix(rows.column(vector_col), dim)
        order = np.argsort(ids, kind="stable")
        cut = [order[i : i + BLOCK] for i in range(0, len(order), BLOCK)]
        return pa.Table.from_pylist([block(dim, part, ids[c], exact[c]) for c in cut], schema=arrow_file)

    arrow_file = pa.schema(
        [("dim", pa.int32()), ("part", pa.int32())]
        + [(n, pa.binary()) for n in ("ids", "low", "width", "cells", "exact")]
    )
    dealt = vectors.select(
        F.size(vector_col).alias("dim"),
        F.pmod(F.xxhash64(id_col, vector_col), F.lit(parts)).cast("int").alias("part"),
        F.col(id_col),
        F.col(vector_col),
    )
    return dealt.groupBy("dim", "part").applyInArrow(build, FILE)


def _search(queries: np.ndarray, own: np.ndarray, blocks: list[dict], k: int) -> list[tuple]:
    """The k best of all blocks for each query: scores and ids, best first."""
    best_s = [np.zeros(0, np.int64)] * len(queries)
    best_i = [np.zeros(0, np.int64)] * len(queries)
    dim = queries.shape[1]
    for b in blocks:
        ids = np.frombuffer(b["ids"], np.int64)
        low, width = np.frombuffer(b["low"], np.int64), np.frombuffer(b["width"], np.int64)
        cells = np.frombuffer(b["cells"], np.uint16).reshape(len(ids), dim)
        exact = np.frombuffer(b["exact"], np.int64).reshape(len(ids), dim)
        largest = np.abs(queries).max(initial=0) * float(np.abs(exact).max(initial=0)) * dim
        fits = largest < 2**51
        # Within a cell a component is at most half a step from the middle.
        half = np.maximum(width - 1, 0) / 2.0
        middle = low + cells * width.astype(np.float64) + half
        as_float = queries.astype(np.float64)
        reach = np.abs(as_float) @ half + (0 if fits else largest * 2.0**-40)
        bounds = as_float @ middle.T + reach[:, None]
        exact_float = exact.astype(np.float64) if fits else None
        for q in range(len(queries)):
            scores, found = best_s[q], best_i[q]
            certain = scores[k - 1] if len(scores) >= k else None
            left = np.flatnonzero(bounds[q] >= certain) if certain is not None else np.arange(len(ids))
            left = left[ids[left] != own[q]]
            if not len(left):
                continue
            left = left[np.argsort(-bounds[q][left], kind="stable")]
            step = max(2 * k, 64)
            for at in range(0, len(left), step):
                if len(scores) >= k and bounds[q][left[at]] < scores[k - 1]:
                    break
                read = left[at : at + step]
                got = (
                    (exact_float[read] @ as_float[q]).astype(np.int64) if fits else exact[read] @ queries[q]
                )
                scores, found = np.concatenate([scores, got]), np.concatenate([found, ids[read]])
                keep = np.lexsort((found, -scores))[:k]
                scores, found = scores[keep], found[keep]
            best_s[q], best_i[q] = scores, found
    return list(zip(best_s, best_i, strict=True))


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    bits: int = 6,
    part_rows: int = 8192,
    part_queries: int = 8192,
) -> DataFrame:
    """For each query the k rows of largest inner product: query_id, rank, vec_id, score.

    vectors, queries: id and integer vector (array<bigint>, see integer_vector). The queries meet
    the rows in tiles of about part_queries by part_rows, each a task of bounded size; a tile
    returns k rows a query at most, and the best of all tiles are ranked.
    """
    usable = [F.col(id_col).isNotNull(), F.col(vector_col).isNotNull()]
    vectors = vectors.where(usable[0] & usable[1]).select(F.col(id_col).cast("long"), vector_col)
    queries = queries.where(usable[0] & usable[1]).select(F.col(id_col).cast("long"), vector_col).distinct()
    queries = settle(queries, "va-queries")
    parts = max(1, -(-vectors.count() // part_rows))
    groups = max(1, -(-queries.count() // part_queries))
    file = settle(build_file(vectors, id_col, vector_col, bits, parts), "va-file")

    every = lambda name, n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    rows = file.select("*", every("query_group", groups))
    asked = queries.select(
        F.col(id_col).alias("query_id"),
        F.col(vector_col).alias("asked"),
        F.xxhash64(id_col, vector_col).alias("query_key"),
        F.size(vector_col).alias("dim"),
        F.pmod(F.xxhash64(id_col, vector_col), F.lit(groups)).cast("int").alias("query_group"),
    ).select("*", every("part", parts))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return empty
        dim = left.column("dim")[0].as_py()
        own = left.column("query_id").to_numpy()
        keys = left.column("query_key").to_numpy()
        found = _search(_matrix(left.column("asked"), dim), own, right.to_pylist(), k)
        counts = [len(s) for s, _ in found]
        return pa.table(
            {
                "query_id": np.repeat(own, counts),
                "query_key": np.repeat(keys, counts),
                "vec_id": np.concatenate([i for _, i in found]),
                "score": np.concatenate([s for s, _ in found]),
            }
        )

    empty = pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "query_key", "vec_id", "score")})
    tiles = (
        asked.groupBy("dim", "query_group", "part")
        .cogroup(rows.groupBy("dim", "query_group", "part"))
        .applyInArrow(tile, FOUND)
    )
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        tiles.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
