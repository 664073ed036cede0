"""Periodic runs of words: maximal stretches that repeat with a smallest period, and texts without them.

A run is a stretch of words in which words a period apart are equal, as long as that holds, with the
smallest such period; it counts if it is at least `repeats` periods and `least` words long.

Multi-scale minimizers. The scale of w looks for periods from w to 2w - 1. Grams of 2w words have one
place in a period, so that equal grams of a run lie whole periods apart, and in a run of at least four
periods a window of w grams and the one a period later both lie inside it. They have the same minimum:
consecutive equal minimizers are then exactly a period apart. Each such pair is a seed, which is
extended to both sides word by word. Grams double from scale to scale, window minima by doubling too,
so that a scale takes a few passes over the batch. Periods below SHORT are scanned for directly, lag by
lag. Both work on all texts of a batch on end, with a word of its own after each text; a scale leaves
out texts too short to hold four of its periods.

Words are compared by 64-bit hashes of their bytes.

Defined results
- Words are maximal runs of characters other than ASCII white space, compared as they are.
- Runs are in the order of start, then period. Two runs may overlap; no two have the same extent.
- A text of no words, or null: no runs, and an empty text without runs.
- Repeated rows: each its own result. Empty tables: no rows. Other columns stay; an added column
  replaces one of its name.
- Memory is bounded by pieces of some megabytes of text, and by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from headway.llm.shared import segments, utf8
from headway.llm.words import mix, span_hashes, spans

#: Periods below this are scanned lag by lag; a power of two.
SHORT = 16
#: Bytes of text that are worked on at once (one text at least).
PIECE = 4 << 20
#: Runs have at least so many periods: windows of a scale need four.
REPEATS = 4
LEAST = 6

RUN = "struct<start: bigint, length: bigint, period: bigint>"
FOUND = f"struct<runs: array<{RUN}>, collapsed: string>"


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest value of each window of width, a power of two."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _short_runs(ids: np.ndarray, repeats: int, least: int) -> list[np.ndarray]:
    """Rows (start, end, period) of stretches with a period below SHORT."""
    found = []
    for p in range(1, min(SHORT, len(ids))):
        same = np.flatnonzero(ids[p:] == ids[:-p])
        need = max((repeats - 1) * p, least - p)
        if len(same) < need:
            continue
        cut = np.flatnonzero(np.diff(same) > 1)
        first = same[np.concatenate(([0], cut + 1))]
        last = same[np.concatenate((cut, [len(same) - 1]))] + 1
        long = last - first >= need
        if long.any():
            found.append(np.column_stack((first[long], last[long] + p, np.full(long.sum(), p))))
    return found


def _reach(ids: np.ndarray, x: int, p: int, low: int, high: int) -> tuple[int, int]:
    """The stretch [start, end) around x in which words p apart are equal, within [low, high)."""
    end, step = x, 64
    while end < high - p:
        stop = min(end + step, high - p)
        differ = np.flatnonzero(ids[end:stop] != ids[end + p : stop + p])
        if len(differ):
            end += int(differ[0])
            break
        end, step = stop, step * 2
    start, step = x, 64
    while start > low:
        stop = max(start - step, low)
        differ = np.flatnonzero(ids[stop:start] != ids[stop + p : start + p])
        if len(differ):
            start = stop + int(differ[-1]) + 1
            break
        start, step = stop, step * 2
    return start, end + p


def _seeds(grams: np.ndarray, places: np.ndarray, w: int) -> np.ndarray:
    """Pairs (period, place): consecutive equal minimizers from w to 2w - 1 apart."""
    least = _sliding(grams, w, np.minimum)
    # A place is a minimizer if its gram is the least of some window that holds it.
    around = np.concatenate((np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)))
    chosen = np.flatnonzero(_sliding(around, w, np.maximum) == grams)
    order = chosen[np.argsort(grams[chosen], kind="stable")]
    here, there = order[:-1], order[1:]
    lag = places[there] - places[here]
    pairs = (grams[here] == grams[there]) & (lag >= w) & (lag < 2 * w)
    return np.column_stack((lag[pairs], places[here[pairs]]))


def runs_of(ids: np.ndarray, starts: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period) of all runs in texts laid on end, in the order of start, then period.

    ids: hashes of the words, with one more after each text that equals no other. starts: where each text
    begins, and the end of all. repeats is at least four.
    """
    found = _short_runs(ids, repeats, least)
    lengths = np.diff(starts) - 1
    grams, places, span = mix(ids), np.arange(len(ids)), 1
    w = 1
    while True:
        # Grams of 2w words, of the texts that can hold `repeats` periods of at least w.
        keep = np.repeat(lengths >= repeats * w, lengths + 1)
        if not keep.any():
            break
        if not keep.all():
            grams, places = grams[keep[places]], places[keep[places]]
        while span < 2 * w and len(grams) > span:
            grams = mix(grams[:-span] * np.uint64(0x9E3779B97F4A7C15) + grams[span:])
            places, span = places[: len(grams)], span * 2
        if w >= SHORT and len(grams) >= w:
            seeds = _seeds(grams, places, w)
            done = (0, 0)
            for p, x in seeds[np.lexsort((seeds[:, 1], seeds[:, 0]))].tolist():
                if done[0] == p and x + p < done[1]:
                    continue
                at = int(np.searchsorted(starts, x, "right")) - 1
                low, high = int(starts[at]), int(starts[at + 1]) - 1
                start, end = _reach(ids, x, p, low, high)
                done = (p, end)
                if end - start >= max(repeats * p, least):
                    found.append(np.array([[start, end, p]]))
        w *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # Of one extent the smallest period counts: the others are its multiples.
    first = np.ones(len(runs), bool)
    first[1:] = (np.diff(runs[:, 0]) != 0) | (np.diff(runs[:, 1]) != 0)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _found(texts: pa.Array) -> pa.Array:
    data, offsets = utf8(texts)
    begin, end, firsts = spans(data, offsets)
    n = len(texts)
    # A word of its own after each text.
    at = firsts + np.arange(n + 1)
    ids = np.empty(len(begin) + n, np.uint64)
    own = np.zeros(len(ids), bool)
    own[at[1:] - 1] = True
    ids[own] = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    ids[~own] = span_hashes(data, begin, end)
    runs = runs_of(ids, at)
    text_of = np.searchsorted(at, runs[:, 0], "right") - 1
    dropped = np.zeros(len(ids) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 1], -1)
    kept = np.cumsum(dropped)[:-1] == 0
    with_runs = set(text_of.tolist())
    raw = data.tobytes()
    collapsed = []
    for i in range(n):
        words = raw[offsets[i] : offsets[i + 1]].split()
        if i in with_runs:
            words = [word for word, k in zip(words, kept[at[i] : at[i + 1] - 1].tolist(), strict=True) if k]
        collapsed.append(b" ".join(words))
    rows = pa.StructArray.from_arrays(
        [pa.array(c) for c in (runs[:, 0] - at[text_of], runs[:, 1] - runs[:, 0], runs[:, 2])],
        ["start", "length", "period"],
    )
    ends = segments(np.bincount(text_of, minlength=n)[:n])
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), rows)
    return pa.StructArray.from_arrays([lists, pa.array(collapsed, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def found(text: Column) -> Column:
    """Runs of a text, and the text without the words of a run after its first period."""

    @arrow_udf(FOUND)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out, start = [], 0
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            while start < len(texts):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + PIECE, "right")))
                out.append(_found(texts.slice(start, stop - start)))
                start = stop
            yield pa.concat_arrays(out) if out else _found(texts)

    return find(text)


def with_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed") -> DataFrame:
    """Adds the runs of a text, and its words joined by one space without what the runs repeat."""
    one = "_".join(["found", *docs.columns])
    found_in = docs.withColumn(one, found(F.col(text_col).cast("string")))
    return found_in.withColumns({runs_col: F.col(one)["runs"], collapsed_col: F.col(one)["collapsed"]}).drop(one)


def strongest(runs: Column) -> Column:
    """The run of greatest length for its period, as an exact fraction (ties: least start, then period)."""
    by_power = F.array_sort(
        runs,
        lambda a, b: F.when(a["length"] * b["period"] > b["length"] * a["period"], -1)
        .when(a["length"] * b["period"] < b["length"] * a["period"], 1)
        .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        .when(a["period"] != b["period"], F.when(a["period"] < b["period"], -1).otherwise(1))
        .otherwise(0),
    )
    return F.get(by_power, F.lit(0))


def stuttered(text: Column, doc_id: Column) -> Column:
    """The words of a text with one tail that repeats, in one document of ten as its id has it.

    With h the crc32 of the id in decimal, g = floor(h / 10) and n words: if 10 divides h and n > 0, each
    word i from a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)). Other
    texts stay as they are; a null id edits nothing.
    """

    @arrow_udf("string")
    def edit(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, hashes in texts:
            yield pa.array(map(_repeated, batch.to_pylist(), hashes.to_pylist()), pa.string())

    return edit(text, F.crc32(doc_id.cast("string")))


def _repeated(text: str | None, h: int | None) -> str | None:
    if text is None or h is None or h % 10:
        return text
    words, g = text.encode().split(), h // 10
    if not words:
        return text
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    tail = [words[a + i % p] for i in range(len(words) - a)]
    return b" ".join(words[:a] + tail).decode()
