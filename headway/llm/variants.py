"""Spelling variants: words one edit apart, and the frequent form that a rare word is a variant of.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. A word's form
is its most frequent near word if that one is `ratio` times as frequent; its root is where forms lead.

Sorted-list dynamic programming. An edit of a word lies in one part of it; both words share what comes
before that part and what comes after. A word is therefore listed, for each half, under the rest of it,
once as the shorter of a pair and once as the longer (lengths differ by one at most), so that a pair
shares a list. A list that grows too long is cut again by halves of the part it varies in, until it is
short or the part is one code point, which bounds it by the alphabet.

Within a list the varying parts are sorted. A word is compared with all of them by the rows of the
edit matrix, of which only the three cells next to the diagonal matter. Neighbours in the list share the
rows of their common prefix (adjacent LCPs), so that rows are computed once for each run of entries with
a common prefix; once all three cells exceed one edit, the run is skipped, and once the edit is spent,
the only runs that can follow are found by binary search. All words of some lists go down together.

Defined results
- Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF of at least `shortest` code points; only A-Z
  are lower-cased. Words seen fewer than `least` times are left out.
- Ties between near words of one frequency: the smallest in code-point order is the form.
- A word without form is its own root. Repeated rows count as often as they occur.
- Null texts have no words, a null id is written as the empty text. Empty tables: no rows. Other columns
  of the documents are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import settle

SHORTEST = 7
#: Counts that a task keeps before it hands them on; the size changes no result.
HELD_WORDS = 200_000
#: Entries of a list before it is cut in two.
LONGEST_LIST = 4_096
#: Entries and code points that are worked on at once (whole lists).
HELD_ENTRIES = 32_768
HELD_CELLS = 4_000_000

FAR = 2


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = 2, slips: int | None = None) -> DataFrame:
    """(word, n): the words of all texts (doc_id, text) and how often each occurs.

    slips: where it divides the unsigned crc32 h of `<doc_id>:<word>`, the document's word is taken
    without its code point h % length.
    """
    run = re.compile(f"[a-zÀ-ÿ]{{{shortest},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # Bytes: only A-Z are lower-cased.
                found = Counter(run.findall(text.encode().lower().decode())) if text else {}
                start = zlib.crc32(f"{doc_id or ''}:".encode())
                for word, n in found.items():
                    if slips:
                        h = zlib.crc32(word.encode(), start)
                        if h % slips == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < shortest:
                                continue
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield out()
        yield out()

    texts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    counted = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def _listed(rows: DataFrame) -> DataFrame:
    """Adds what the two words of a pair share, and the part (from low to high of the shorter) that varies."""
    tail = F.col("m") - F.col("high")
    n = F.length("word")
    parts = {
        "prefix": F.substring("word", F.lit(1), F.col("low")),
        "suffix": F.substring("word", n - tail + 1, tail),
        "middle": F.substring("word", F.col("low") + 1, n - tail - F.col("low")),
    }
    return rows.withColumns(parts).withColumn("list", F.xxhash64("m", "low", "high", "prefix", "suffix"))


def _halves(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    parts = F.array(
        F.struct(F.col("low"), middle.alias("high")),
        F.struct(middle.alias("low"), F.col("high")),
    )
    return rows.withColumn("part", F.explode(parts)).select("word", "n", "m", "part.low", "part.high")


def lists(words: DataFrame, longest: int = LONGEST_LIST) -> DataFrame:
    """Every word under what it would share with a near word; no list has more than `longest` entries or
    HELD_CELLS code points that vary, or else it varies in one."""
    n = F.length("word")
    lengths = F.when(n > 1, F.array(n, n - 1)).otherwise(F.array(n))
    rows = words.withColumn("m", F.explode(lengths)).select("word", "n", "m", F.lit(0).alias("low"), F.col("m").alias("high"))
    done, purpose = [], "variant-lists"
    rows = _listed(_halves(rows))
    while True:
        # Lists of one entry hold no pair.
        sizes = rows.groupBy("list").agg(F.count("*").alias("entries"), F.max(F.col("high") - F.col("low")).alias("width"))
        many = settle(sizes.where("entries > 1"), purpose)
        large = (F.col("entries") > longest) | (F.col("entries") * F.col("width") > HELD_CELLS)
        long = large & (F.col("width") > 1)
        done.append(rows.join(many.where(~long).select("list"), "list", "left_semi"))
        if many.where(long).isEmpty():
            break
        hot = rows.join(many.where(long).select("list"), "list", "left_semi")
        rows = settle(_listed(_halves(hot.select("word", "n", "m", "low", "high"))), purpose)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("list", "m", "low", "prefix", "suffix", "middle", "n")


def _chars(texts: list[str], width: int) -> np.ndarray:
    """Code points, one text a row, zeros after its end."""
    return np.array(texts, f"U{width}").view(np.uint32).reshape(len(texts), width)


def near_rows(lists_of: np.ndarray, texts: list[str], asking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (asking row, row of its list) of texts one edit apart.

    Rows are sorted by list, then text; a list holds no text twice, and no text is empty. Entries that begin alike are one node
    at each depth: a range of rows, found from the LCPs of neighbours.
    """
    width = max(map(len, texts)) + 2
    chars = _chars(texts, width)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    n = len(texts)
    lcp = np.full(n, -1, np.int64)
    if n > 1:
        lcp[1:] = np.where(lists_of[1:] == lists_of[:-1], (chars[1:] != chars[:-1]).argmax(axis=1), -1)
    first = np.flatnonzero(lcp < 0)
    q = np.flatnonzero(asking)
    at = np.searchsorted(first, q, "right") - 1
    # Cells of the edit matrix at a word's length one less, equal to and one more than the depth.
    less, equal = np.full(len(q), FAR, np.int8), np.zeros(len(q), np.int8)
    more = np.where(lengths[q] > 0, 1, FAR).astype(np.int8)
    asked, met = [], []
    for depth in range(width - 1):
        below = np.flatnonzero(lcp <= depth)
        parent = np.searchsorted(first, below, "right") - 1
        char = chars[below, depth]
        key = parent * (1 << 21) + char
        before, here, after = (chars[q, max(depth - 1, 0)], chars[q, depth], chars[q, depth + 1])
        # With an edit to spare every entry may follow; otherwise only one that repeats the word.
        free = np.flatnonzero(equal == 0)
        low, high = np.searchsorted(parent, at[free]), np.searchsorted(parent, at[free], "right")
        many = high - low
        ask = [np.repeat(free, many)]
        node = [np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)]
        spent = equal != 0
        tried: list[tuple[np.ndarray, np.ndarray]] = []
        for cell, follows in ((less, before), (equal, here), (more, after)):
            wanted = spent & (cell == 1) & (follows != 0)
            for earlier, same in tried:
                wanted &= ~(earlier & (same == follows))
            tried.append((wanted, follows))
            some = np.flatnonzero(wanted)
            sought = at[some] * (1 << 21) + follows[some]
            place = np.minimum(np.searchsorted(key, sought), len(key) - 1)
            hit = key[place] == sought
            ask.append(some[hit])
            node.append(place[hit])
        i, k = np.concatenate(ask), np.concatenate(node)
        real = char[k] != 0
        i, k = i[real], k[real]
        x, long = char[k], lengths[q[i]]
        next_less = np.minimum(equal[i] + 1, less[i] + (before[i] != x) if depth else FAR)
        next_equal = np.minimum(np.minimum(equal[i] + (here[i] != x), more[i] + 1), next_less + 1)
        next_equal = np.where(depth + 1 <= long, next_equal, FAR)
        next_more = np.where(depth + 2 <= long, np.minimum(more[i] + (after[i] != x), next_equal + 1), FAR)
        stay = np.minimum(np.minimum(next_less, next_equal), next_more) <= 1
        i, k = i[stay], k[stay]
        less, equal, more = (np.minimum(c[stay], FAR).astype(np.int8) for c in (next_less, next_equal, next_more))
        q, at, first = q[i], k, below
        if not len(q):
            break
        row = first[at]
        over = lengths[q] - (depth + 1)
        distance = np.select([over == -1, over == 0, over == 1], [less, equal, more], FAR)
        ends = (lengths[row] == depth + 1) & (distance == 1)
        asked.append(q[ends])
        met.append(row[ends])
    if not asked:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(asked), np.concatenate(met)


def _pairs(entries: pa.Table) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n) of whole lists, sorted by list and middle; lists of like width go together."""
    columns = {c: entries.column(c).combine_chunks() for c in entries.column_names}
    n = entries.num_rows
    new = np.zeros(n, bool)
    for c in ("list", "m", "low", "prefix", "suffix"):
        new[1:] |= pc.not_equal(columns[c].slice(1), columns[c].slice(0, n - 1)).to_numpy(zero_copy_only=False)
    list_no = np.cumsum(new)
    length, before, after = (pc.utf8_length(columns[c]).to_numpy() for c in ("middle", "prefix", "suffix"))
    m = columns["m"].to_numpy()
    asking = length + before + after == m
    # Of the shorter words of a list; the longer have one code point more.
    scale = np.frexp(m - before - after)[1]
    words = pc.binary_join_element_wise(columns["prefix"], columns["middle"], columns["suffix"], "")
    for s in np.unique(scale):
        rows = np.flatnonzero(scale == s)
        first = np.flatnonzero(np.diff(list_no[rows], prepend=-1))
        piece = (first << int(s)) // HELD_CELLS
        cuts = np.append(first[np.flatnonzero(np.diff(piece, prepend=-1))], len(rows))
        for some in (rows[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)):
            middles = columns["middle"].take(pa.array(some)).to_pylist()
            i, j = near_rows(list_no[some], middles, asking[some])
            # An edit at the end of a part that is not the last also shows in the next part.
            alike = [middles[y].startswith(middles[x]) for x, y in zip(i.tolist(), j.tolist(), strict=True)]
            longer = length[some[j]] > length[some[i]]
            once = ~(longer & np.array(alike, bool) & (after[some[i]] > 0))
            i, j, longer = some[i[once]], some[j[once]], longer[once]
            left, right = pa.array(np.concatenate((i, j[longer]))), pa.array(np.concatenate((j, i[longer])))
            yield pa.RecordBatch.from_arrays(
                [words.take(left), words.take(right), columns["n"].take(right)], ["word", "near", "near_n"]
            )


def _in_whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < HELD_ENTRIES and sum(b.nbytes for b in held) < HELD_CELLS:
            continue
        entries = pa.Table.from_batches(held)
        keys = entries.column("list").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield from _pairs(entries.slice(0, cut))
        held = entries.slice(cut).combine_chunks().to_batches()
    if held:
        yield from _pairs(pa.Table.from_batches(held))


def near_words(words: DataFrame, longest: int = LONGEST_LIST) -> DataFrame:
    """(word, near, near_n): each word of (word, n) with every near word and how often that occurs."""
    dealt = lists(words, longest).repartition("list").sortWithinPartitions("list", "m", "low", "prefix", "suffix", "middle")
    return dealt.mapInArrow(_in_whole_lists, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where following forms from word to word ends. Forms have no cycle."""
    steps = settle(forms.select(F.col("word").alias("at"), F.col("form").alias("next")), "variant-forms")
    reached = steps.select(F.col("at").alias("word"), F.col("next").alias("root"))
    while True:
        further = reached.join(steps, F.col("root") == F.col("at"), "left")
        further = settle(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        if further.where("moved").isEmpty():
            return further.select("word", "root")
        # Who arrived stays as it is; the others go on from where they are.
        reached = further.select("word", "root")


def variants(words: DataFrame, ratio: int = 10, longest: int = LONGEST_LIST) -> DataFrame:
    """word, form, root, n, n_near, form_n for (word, n), one row for each word."""
    one = words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    words = settle(one, "variant-words")
    best = near_words(words, longest).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    judged = settle(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "variant-judged",
    )
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
