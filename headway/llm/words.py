"""Words of a batch of texts as 64-bit hashes, computed on the bytes of the whole batch at once.

A word is a maximal run of characters other than ASCII white space; A-Z count as a-z. The bytes of
a UTF-8 character are never those of ASCII white space, so that working on bytes cuts no character.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from headway.llm.shared import utf8

BASE = 0x9E3779B97F4A7C15
WORD = (1 << 64) - 1
WINDOW = 1 << 20


def mix(values: np.ndarray) -> np.ndarray:
    """Scatters 64-bit values: each bit of the input reaches all bits of the result."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(base: int, length: int) -> np.ndarray:
    steps = np.full(length, base & WORD, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in data, and the first word of each text (one more than texts)."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # A text begins and ends a word even where no white space stands between two texts.
    filled = offsets[:-1][np.diff(offsets) > 0]
    starts[filled] = inside[filled]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends[last] = inside[last]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(first, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: a polynomial of its bytes, by differences of prefix sums."""
    out = np.empty(len(starts), np.uint64)
    inverse = pow(BASE, -1, 1 << 64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + WINDOW, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        length = max(WINDOW, high - low) + 1
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(
            (data[low:high].astype(np.uint64) + np.uint64(1)) * _powers(BASE, length)[: high - low],
            out=sums[1:],
        )
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * _powers(inverse, length)[a] + (b - a).astype(np.uint64)
        i = j
    return mix(out)


def word_hashes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the offset of each text's first word."""
    data, offsets = utf8(texts)
    lower = data | (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    starts, ends, firsts = spans(lower, offsets)
    return span_hashes(lower, starts, ends), firsts
