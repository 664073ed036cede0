"""BPE encoding and decoding with a public vocabulary file.

The symbols of a piece form a doubly linked list. A heap holds the mergeable neighbours by merge
rank, then place; an entry is stale, and skipped, if one of its two symbols has since changed. To
decode is to put the vocabulary strings of the ids on end.

The file states the normaliser (NFC, runs of white space to one space, lower case), the pattern that
splits text into pieces, the byte-level alphabet and the suffix of a piece's last symbol. Files that
ask for other steps are refused.

Defined results
- Null text: no ids. Empty text or white space: no ids. Null or empty ids decode to empty text.
- Special tokens that stand in a text become their ids; none are added.
- An id that the vocabulary lacks decodes to nothing.
- encode and decode add a column (replacing one of that name) and keep all rows and other columns.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from headway.llm.shared import list_array, segments

#: Entries a worker keeps of words it has met; beyond that it starts again. A cache only.
CACHED = 300_000
#: Marks a symbol that has been merged into the one before it; no id is as large.
GONE = 0x7FFFFFFF
#: Blank for Python's str.split() but not for the pattern's \s.
NOT_BLANK = regex.compile("[\x1c-\x1f]")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [hidden.get(b, chr(b)) for b in range(256)]


class Kept(dict):
    """A bounded memo of a function of one string."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, key):
        if len(self) >= CACHED:
            self.clear()
        value = self[key] = self.function(key)
        return value


class Codec:
    """Vocabulary, merges and text steps of one file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        model = spec["model"]
        plain = not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"))
        if steps != ["NFC", "Replace", "Lowercase"] or level["type"] != "ByteLevel" or not (split["invert"] and plain):
            raise ValueError(f"{path} asks for steps that this encoder does not have")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {vocab[a] << 32 | vocab[b]: rank << 32 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        letters = byte_alphabet()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + self.suffix] for c in letters]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_length = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(map(regex.escape, by_length))) if by_length else None
        self.strings = dict(map(reversed, vocab.items())) | {i: s for s, i in self.special.items()}
        self.forget()

    def forget(self) -> None:
        """Starts anew what is remembered of the words met so far."""
        self.pieces = Kept(self.merge)
        self.chunks = Kept(self.chunk)

    def merge(self, piece: str) -> bytes:
        """Ids of one piece, as the bytes of 32-bit integers.

        A heap entry is one number, rank and new id above the place; it is stale if the symbols that
        are now at its place would not merge to just that.
        """
        data = piece.encode()
        inner, merge_of = self.inner, self.merges.get
        ids = [inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        n = len(ids)
        heap = []
        for at in range(n - 1):
            if (found := merge_of(ids[at] << 32 | ids[at + 1])) is not None:
                heap.append(found << 32 | at)
        if not heap:
            return array("i", ids).tobytes()
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            at = entry & 0xFFFFFFFF
            other = after[at]
            if other >= n or merge_of(ids[at] << 32 | ids[other]) != entry >> 32:
                continue
            new = entry >> 32 & 0xFFFFFFFF
            ids[at], ids[other] = new, GONE
            after[at] = following = after[other]
            if following < n:
                before[following] = at
                if (found := merge_of(new << 32 | ids[following])) is not None:
                    heappush(heap, found << 32 | at)
            previous = before[at]
            if previous >= 0 and (found := merge_of(ids[previous] << 32 | new)) is not None:
                heappush(heap, found << 32 | previous)
        return array("i", [i for i in ids if i != GONE]).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Ids of a run of characters without white space."""
        pieces = self.pieces
        if chunk.isalpha():
            return pieces[chunk]
        return b"".join([pieces[p] for p in self.pattern.findall(chunk)])

    def plain(self, text: str) -> bytes:
        if not text.isascii():
            # Lower-casing goes by character: a final capital sigma becomes the plain small one.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if NOT_BLANK.search(text):
            return b"".join([self.pieces[p] for p in self.pattern.findall(text)])
        chunks = self.chunks
        return b"".join([chunks[c] for c in text.split()])

    def encode(self, text: str) -> bytes:
        if self.special_pattern is None or not (found := list(self.special_pattern.finditer(text))):
            return self.plain(text)
        out, at = [], 0
        for m in found:
            out += [self.plain(text[at : m.start()]), np.int32(self.special[m[0]]).tobytes()]
            at = m.end()
        return b"".join([*out, self.plain(text[at:])])

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings on end, a space between two, as files without a decoder ask for."""
        strings = self.strings
        try:
            return " ".join([strings[i] for i in ids])
        except KeyError:
            return " ".join([strings[i] for i in ids if i in strings])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(text: Column, path: str) -> Column:
    """Token ids of a text: array<int>."""

    @arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # A worker lives on after the task; what it remembers of this one's words should not.
        one = codec(path)
        one.forget()
        for texts in batches:
            data = [one.encode(t) if t else b"" for t in texts.to_pylist()]
            lengths = np.array([len(d) // 4 for d in data], np.int64)
            yield list_array(np.frombuffer(b"".join(data), np.int32), segments(lengths))
        one.forget()

    return encode(text)


def decoded(ids: Column, path: str) -> Column:
    """Text of token ids."""

    @arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = codec(path)
        for lists in batches:
            ends = segments(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            texts = [one.decode(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.array(texts, pa.string())

    return decode(ids)


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    return docs.withColumn(ids_col, encoded(F.col(text_col), path))


def decode(tokens: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    return tokens.withColumn(text_col, decoded(F.col(ids_col), path))
