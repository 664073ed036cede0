"""Near-duplicate join on word shingles by prefixes of MinHash signatures.

Each tree has a signature of MinHash values of its own; documents that agree on its first values, a
prefix of fixed length, meet in a node. The lengths are as long as can be for a pair at the threshold
to meet in some node with the target recall; they come from the threshold, the number of trees and the
recall, not from the data (banded LSH, no adaptive descent). Whatever meets is then verified exactly.

How it holds up
- Rows with equal shingle sets are one set from the start; only their number is carried on. Sets are told
  apart by a number of their own, never by an id, which rows may share.
- Node members are tied to the least member, never listed as pairs. The sets that hang together that
  way are compared in cells: pairs of hash-dealt blocks of `block` sets, each cell a task of bounded
  size. A cell counts the links of each set and ties what is linked; no pair leaves it.
- Shingles are taken again from one text of each of those sets, found by its id and the hash of the text, and
  go once to each cell. Only texts that pass a filter of the sets' ids and hashes are shuffled, a bitmap of at
  most `FILTER_BITS`; rows that repeat such a text under its id are combined before that.

Defined results
- A document's words are lower-cased (A-Z) runs without ASCII white space. Fewer words than a shingle
  has: all of them are its one shingle. Shingles are compared as 64-bit hashes.
- Each row is a document, also one whose id or whole content another has. class_id is the least id of all
  documents that links lead to; n_links counts the other documents whose similarity to this one is at
  least the threshold, copies included.
- Null text, or no words: a class of its own, no links. Null id: null class, no links; takes no part.
- Rows that share an id and have unlike texts are in different classes, of which two can have the same
  class_id; `class_key`, on demand, tells these apart.
- Empty table: no rows. Other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.components import components
from headway.llm.shared import list_array, pieces, segments, settle
from headway.llm.words import mix, word_hashes

SEED = 20_240_607
PIECE = 2 << 20
#: Bits of the filter a row that is looked for, and of the whole filter: 8 MB. Beyond two million rows it lets more
#: of the others pass, which the join after it drops.
BITS_PER_ROW, FILTER_BITS = 32, 1 << 26


def prefix_depths(threshold: float, trees: int, deepest: int, recall: float) -> list[int]:
    """Prefix length of each tree: as long as can be for pairs at the threshold to meet often enough."""
    depths = [deepest] * trees
    at = 0
    while 1 - float(np.prod([1 - threshold**d for d in depths])) < recall:
        if depths[at] == 1:
            raise ValueError("more trees are needed for this recall")
        depths[at] -= 1
        at = (at + 1) % trees
    return depths


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, and where those of each text begin."""
    words, firsts = word_hashes(texts)
    counts = np.diff(firsts)
    rolled = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        factor = np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
        rolled += words[k : k + len(rolled)] * factor
    rolled = mix(rolled)
    out = []
    for first, n in zip(firsts[:-1].tolist(), counts.tolist(), strict=True):
        if n >= width:
            out.append(np.unique(rolled[first : first + n - width + 1]))
        elif n:
            tail = words[first : first + n]
            powers = np.array([pow(0xA0761D6478BD642F, k + 1, 1 << 64) for k in range(n)], np.uint64)
            out.append(mix(np.array([(tail * powers).sum()], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), segments(np.array([len(x) for x in out], np.int64))


def nodes(sets: np.ndarray, starts: np.ndarray, depths: list[int]) -> np.ndarray:
    """The trie node of each non-empty set in each tree: a hash of tree and signature prefix."""
    factors = np.random.default_rng(SEED).integers(0, 1 << 63, (sum(depths), 2), np.int64).astype(np.uint64)
    out = np.empty((len(starts), len(depths)), np.uint64)
    k = 0
    for tree, depth in enumerate(depths):
        prefix = np.full(len(starts), tree + 1, np.uint64)
        for _ in range(depth):
            mask, factor = factors[k]
            least = np.minimum.reduceat((sets ^ mask) * (factor | np.uint64(1)), starts)
            prefix = mix(prefix * np.uint64(0x9E3779B97F4A7C15) + (least >> np.uint64(24)))
            k += 1
        out[:, tree] = prefix
    return out


def sign(docs: DataFrame, id_col: str, text_col: str, width: int, depths: list[int]) -> DataFrame:
    """One row per document: id, hash of the text, key of its shingle set (null: no words), trie nodes."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            sets, offsets = shingles(batch.column("text"), width)
            filled = np.diff(offsets) > 0
            starts = offsets[:-1][filled]
            keys = np.zeros((len(filled), 2), np.uint64)
            found = np.zeros((0, len(depths)), np.uint64)
            if len(starts):
                found = nodes(sets, starts, depths)
                keys[filled, 0] = np.add.reduceat(mix(sets), starts)
                keys[filled, 1] = np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), starts)
            raw = keys.byteswap().tobytes()
            key = [raw[16 * i : 16 * i + 16] if f else None for i, f in enumerate(filled.tolist())]
            lists = list_array(found.ravel().view(np.int64), segments(filled.astype(np.int64) * len(depths)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(key, pa.binary()), lists],
                ["doc_id", "text_key", "set_key", "nodes"],
            )

    rows = keyed(docs, id_col, text_col)
    return rows.mapInArrow(signed, "doc_id long, text_key long, set_key binary, nodes array<long>")


def text_key(text: Column) -> Column:
    """Tells the texts of rows that share an id apart."""
    return F.xxhash64(text.cast("string"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text).alias("text_key"), text.cast("string").alias("text"))


def among(rows: DataFrame, wanted: DataFrame, columns: list[str], most: int = FILTER_BITS) -> DataFrame:
    """The rows whose values of `columns` some row of `wanted` has, and a few others; no row is shuffled.

    Every task holds a bitmap of the hashes of the wanted values, in pieces of 4 KB. It is broadcast whatever the
    session's threshold: its size is bounded by `most` bits, not by the rows.
    """
    bits, enough = 1 << 15, BITS_PER_ROW * wanted.count()
    while bits < min(most, enough):
        bits *= 2
    place = F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1
    pieces_of = wanted.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("piece"))
    maps = settle(pieces_of.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")), "filter")
    at = F.bitmap_bit_position("place").cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return (
        rows.withColumn("place", place)
        .withColumn("piece", F.bitmap_bucket_number("place"))
        .join(F.broadcast(maps), "piece")
        .where(F.getbit(byte, at % 8) == 1)
        .select(rows.columns)
    )


def _overlaps(lists: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of shared values of each left and each right list, by products of incidence columns."""
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    values = np.concatenate(lists)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    column = np.cumsum(fresh) - 1
    several = np.bincount(column)[column] > 1
    owner, column = owner[several], column[several]
    if not len(column):
        return np.zeros((len(left), len(right)), np.float32)
    column = np.cumsum(np.concatenate([[0], (np.diff(column) > 0).astype(np.int64)]))
    total = np.zeros((len(left), len(right)), np.float32)
    step = 16_384
    for low in range(0, int(column[-1]) + 1, step):
        a, b = np.searchsorted(column, [low, low + step])
        wide = np.zeros((len(lists), min(step, int(column[-1]) + 1 - low)), np.float32)
        wide[owner[a:b], column[a:b] - low] = 1
        total += wide[left] @ wide[right].T
    return total


CELL_FIELDS = [("id", pa.int64()), ("links", pa.int64()), ("hub", pa.int64())]


def verify_cell(rows: pa.Table, threshold: float) -> pa.Table:
    """For each set of a cell the weight of its links there, and the least set it hangs together with."""
    ids, weights = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
    block = rows.column("block").to_numpy()
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    lists = [x.values.to_numpy() for x in rows.column("shingles")]
    sizes = np.array([len(x) for x in lists], np.float64)
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    if not (len(left) and len(right)):
        return pa.table([pa.array([], t) for _, t in CELL_FIELDS], pa.schema(CELL_FIELDS))
    shared = _overlaps(lists, left, right).astype(np.float64)
    linked = shared / (sizes[left][:, None] + sizes[right][None, :] - shared) >= threshold
    linked &= ids[left][:, None] != ids[right][None, :]
    links = np.zeros(len(ids), np.int64)
    links[left] += linked @ weights[right]
    if low != high:
        links[right] += linked.T @ weights[left]
    hub = ids.copy()
    far = np.iinfo(np.int64).max
    while True:
        before = hub.copy()
        hub[left] = np.minimum(hub[left], np.where(linked, hub[right][None, :], far).min(axis=1))
        hub[right] = np.minimum(hub[right], np.where(linked, hub[left][:, None], far).min(axis=0))
        if (before == hub).all():
            break
    return pa.table([pa.array(ids), pa.array(links), pa.array(hub)], pa.schema(CELL_FIELDS))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    threshold: float = 0.8,
    trees: int = 20,
    deepest: int = 8,
    recall: float = 0.9999,
    block: int = 256,
    keys: bool = False,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links.

    keys: also text_key, the hash of the text, and class_key, a number of the class (null: no words).
    """
    depths = prefix_depths(threshold, trees, deepest, recall)
    signed = settle(sign(docs, id_col, text_col, width, depths), "forest-signed")
    sets = settle(
        signed.where("doc_id is not null and set_key is not null")
        .groupBy("set_key")
        .agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_key")).alias("least"), F.first("nodes").alias("nodes"))
        .select(F.monotonically_increasing_id().alias("id"), "set_key", "copies", "least.*", "nodes"),
        "forest-sets",
    )
    members = sets.select("id", F.explode("nodes").alias("node"))
    shared = settle(
        members.groupBy("node").agg(F.min("id").alias("hub"), F.max("id").alias("far")).where("hub < far").drop("far"),
        "forest-nodes",
    )
    meeting = settle(
        components(members.join(shared, "node").select(F.col("id").alias("u"), F.col("hub").alias("v"))),
        "forest-meeting",
    )

    # Cells: every pair of blocks of a component, and the sets of both blocks in each.
    blocks = settle(
        meeting.groupBy("component").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")),
        "forest-blocks",
    )
    placed = (
        meeting.join(blocks, "component")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .join(sets.select("id", "copies", "doc_id", "text_key"), "id")
    )
    placed = settle(placed, "forest-placed")

    def with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            found, offsets = shingles(batch.column("text"), width)
            columns = [batch.column(n) for n in ("id", "component", "blocks", "block", "copies")]
            lists = list_array(found.view(np.int64), offsets)
            yield pa.RecordBatch.from_arrays(
                [*columns, lists], ["id", "component", "blocks", "block", "copies", "shingles"]
            )

    # Grouped before the join, which is by the same columns: a text is shuffled once.
    one_text = ["doc_id", "text_key"]
    held = (
        among(keyed(docs, id_col, text_col), placed.select(one_text), one_text)
        .groupBy(one_text)
        .agg(F.min("text").alias("text"))
        .join(placed, one_text)
        .select("id", "component", "blocks", "block", "copies", "text")
        .mapInArrow(with_shingles, "id long, component long, blocks int, block int, copies long, shingles array<long>")
    )
    held = held.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "component",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "id",
        "block",
        "copies",
        "shingles",
    )

    def verify(rows: pa.Table) -> pa.Table:
        return verify_cell(rows, threshold)

    verified = settle(
        held.groupBy("component", "low", "high").applyInArrow(verify, "id long, links long, hub long"),
        "forest-verified",
    )
    classes = components(verified.select(F.col("id").alias("u"), F.col("hub").alias("v")))
    links = verified.groupBy("id").agg(F.sum("links").alias("links"))
    tied = sets.select("id", "set_key", "copies", "doc_id").join(classes, "id", "left")
    least = settle(
        tied.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("class")), "forest-least"
    )
    by_set = settle(
        tied.join(links, "id", "left")
        .join(least, "component", "left")
        .select(
            "set_key",
            F.coalesce("class", "doc_id").alias("class"),
            F.coalesce("component", "id").alias("class_key"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "forest-classes",
    )
    more = ["text_key", "class_key"] if keys else []
    return signed.select("doc_id", "text_key", "set_key").join(by_set, "set_key", "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        *more,
    )
