"""Language identification that asks for the word first and backs off to character n-grams.

A word of the vocabulary scores by its log frequency in each language. At each place of any other
word the longest known n-gram that ends there scores by its log frequency among those of its length;
the mean over the places is the word's score. A text's score is the sum over its words and the prior.

Workers hold the words that come most often, at most about `max_words` over all languages, as a cache
that changes no result: with L languages max_words * (L + 2) numbers and the words. Any other word of a
text is looked up, once for all texts, in the table of all counted words by a join; a word of no labelled
text takes its n-grams from the table of all counted n-grams. Only texts with such words take part.

Defined results
- Words are lower-cased runs of a-z and characters outside ASCII.
- Null text, or text without a letter: `und`, score 0. No learned language: `und` for all.
- Otherwise a learned language, ties to the first in alphabetical order; the score is its posterior
  on the evidence of 20 average words, or fewer if the text is shorter.
- Null or blank languages teach nothing. Repeated rows count again. Empty tables: no rows.
- All rows and columns stay; `lang_pred` and `score` replace columns of these names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from headway.llm.shared import segments, settle

LONGEST = 4
EVIDENCE = 20
SMOOTHING = 0.5
#: Entries of a task's counter before it passes them on.
HELD = 250_000
#: ASCII other than letters separates words.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str) -> list[str]:
    return text.lower().encode("utf-8", "replace").translate(LETTERS).decode("utf-8", "replace").split()


def ngrams(words: list[str], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that end at each place of the words, and the word of each place.

    Words begin and end with a mark. Row n - 1 holds the n-grams of n characters, 0 where the word
    does not reach back so far.
    """
    marked = "".join([f"\x01{w}\x02" for w in words])
    codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.cumsum(codes == 1) - 1
    depth = np.arange(len(codes)) - np.flatnonzero(codes == 1)[word] + 1
    out = np.zeros((longest, len(codes)), np.uint64)
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, longest + 1):
        back = np.zeros(len(codes), np.uint64)
        back[n - 1 :] = codes[: len(codes) - n + 1]
        rolled = rolled + (back + np.uint64(1)) * np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64))
        value = rolled ^ (rolled >> np.uint64(29))
        value = value * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
        out[n - 1] = np.where(depth >= n, value | np.uint64(1), 0)
    return out, word


class Model:
    """Log frequencies by language: of words, and of n-grams by hash."""

    def __init__(self, languages: list[str], priors: np.ndarray, words: dict[str, int], word_logs: np.ndarray,
                 grams: list[np.ndarray], gram_logs: list[np.ndarray]):
        self.languages, self.priors = languages, priors
        self.words, self.word_logs = words, word_logs
        self.grams, self.gram_logs = grams, gram_logs
        #: Log frequencies of all words (word, logs) and of all n-grams (size, gram, logs); not sent to workers.
        self.tables: tuple[DataFrame, DataFrame] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tables": None}

    def unseen(self, words: list[str]) -> np.ndarray:
        """Scores of words that the vocabulary lacks."""
        hashes, word = ngrams(words, len(self.grams))
        places = np.zeros((len(word), len(self.languages)), np.float32)
        left = np.arange(len(word))
        for n in range(len(self.grams), 0, -1):
            known = self.grams[n - 1]
            if not len(left) or not len(known):
                continue
            asked = hashes[n - 1][left]
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            hit = known[at] == asked
            places[left[hit]] = self.gram_logs[n - 1][at[hit]]
            left = left[~hit]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        return np.add.reduceat(places, first) / np.diff(first, append=len(word))[:, None]

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """Of each text the summed scores of its words, how many they are, and those not held here."""
        counts, words = [], []
        for t in texts:
            own = words_of(t) if t else []
            counts.append(len(own))
            words += own
        at = np.fromiter(map(self.words.get, words, (-1 for _ in words)), np.int64, len(words))
        logs = np.zeros((len(at), len(self.languages)), np.float64)
        logs[at >= 0] = self.word_logs[at[at >= 0]]
        ends = segments(np.array(counts, np.int64))
        sums = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0)])
        missing = np.flatnonzero(at < 0)
        cut = np.searchsorted(missing, ends)
        lacked = [[words[i] for i in missing[x:y].tolist()] for x, y in zip(cut[:-1], cut[1:])]
        return sums[ends[1:]] - sums[ends[:-1]], np.array(counts, np.int64), lacked

    def decide(self, sums: np.ndarray, counts: np.ndarray, lettered: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of texts by their summed scores, and whether they have a letter."""
        n = np.maximum(counts, 1)[:, None]
        evidence = sums / n * np.minimum(n, EVIDENCE) + self.priors
        evidence -= evidence.max(axis=1, keepdims=True)
        share = np.exp(evidence)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        names = [self.languages[b] if x else "und" for x, b in zip(lettered.tolist(), best.tolist(), strict=True)]
        return names, np.where(lettered, share[np.arange(len(best)), best], 0.0)


def count_words(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, word, n) over all texts, counted within tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = defaultdict(Counter)

        def emit() -> pa.RecordBatch:
            rows = [(lang, w, n) for lang, c in counters.items() for w, n in c.items()]
            counters.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(x), t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))],
                ["lang", "word", "n"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counters[lang].update(words_of(text))
                if sum(map(len, counters.values())) > HELD:
                    yield emit()
        if any(counters.values()):
            yield emit()

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.trim("lang") != "")
    )
    counted = rows.mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def count_ngrams(words: DataFrame, longest: int) -> DataFrame:
    """(lang, size, gram, n) over counted words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            text, weight = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for lang in sorted(set(langs)):
                own = np.flatnonzero(langs == lang)
                hashes, word = ngrams([text[i] for i in own], longest)
                for n in range(1, longest + 1):
                    some = hashes[n - 1] != 0
                    grams, at = np.unique(hashes[n - 1][some], return_inverse=True)
                    sums = np.bincount(at, weight[own][word[some]], len(grams)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(grams), pa.string()),
                            pa.array(np.full(len(grams), n, np.int32)),
                            pa.array(grams.view(np.int64)),
                            pa.array(sums),
                        ],
                        ["lang", "size", "gram", "n"],
                    )

    counted = words.mapInArrow(count, "lang string, size int, gram long, n long")
    return counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, group: list[str], most: int) -> DataFrame:
    """The entries of each group counted often enough that about `most` of them remain.

    The bound comes from how many entries there are of each magnitude (an eighth of a power of two):
    a few hundred rows a group, so that nothing has to be sorted or ranked.
    """
    magnitude = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(*group, magnitude.alias("m")).agg(F.count("*").alias("k"), F.min("n").alias("least"))
    bounds: dict[tuple, int] = {}
    totals: Counter = Counter()
    for r in sorted(sizes.collect(), key=lambda r: -r.m):
        key = tuple(r[g] for g in group)
        totals[key] += r.k
        if totals[key] <= most or key not in bounds:
            bounds[key] = r.least
    if not bounds:
        return counts.limit(0)
    rows = [(*k, v) for k, v in bounds.items()]
    kinds = ", ".join(f"{g} {dict(counts.dtypes)[g]}" for g in group)
    limits = counts.sparkSession.createDataFrame(rows, f"{kinds}, bound long")
    return counts.join(F.broadcast(limits), group).where("n >= bound").drop("bound")


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
          max_words: int = 200_000, max_ngrams: int = 100_000) -> Model | None:
    """Model of all labelled texts; null if there are none."""
    words = settle(count_words(docs, text_col, lang_col), "language-words")
    grams = settle(count_ngrams(words, longest), "language-ngrams")
    totals = {r.lang: (r.n, r.k) for r in words.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()}
    languages = sorted(totals)
    if not languages:
        return None
    place = {lang: i for i, lang in enumerate(languages)}
    weight = np.array([totals[lang][0] for lang in languages], np.float64)
    priors = np.log(weight / weight.sum())

    def logs(rows: pa.Table, key: str, totals: np.ndarray, types: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The distinct keys of (lang, key, n) rows and their log frequency by language."""
        coded = rows.column(key).combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        counts = np.zeros((len(coded.dictionary), len(languages)))
        column = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
        counts[coded.indices.to_numpy(), column] = rows.column("n").to_numpy()
        return coded.dictionary, np.log((counts + SMOOTHING) / (totals + SMOOTHING * types)).astype(np.float32)

    # A word or n-gram that is kept for one language is kept with its counts in all of them.
    kept = most_frequent(words, ["lang"], max(1, max_words // len(languages))).select("word").distinct()
    rows = words.join(kept, "word").select("lang", "word", "n").toArrow()
    types = np.array([totals[lang][1] for lang in languages], np.float64)
    found, word_logs = logs(rows, "word", weight, types)
    index = {w: i for i, w in enumerate(found.to_pylist())}

    kept = most_frequent(grams, ["lang", "size"], max(1, max_ngrams // len(languages)))
    kept = kept.select("size", "gram").distinct()
    rows = grams.join(kept, ["size", "gram"]).select("lang", "gram", "n", "size").toArrow()
    by_size = grams.groupBy("lang", "size").agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    sums = {(r.lang, r["size"]): (r.n, r.k) for r in by_size.collect()}
    gram_keys, gram_logs = [], []
    for n in range(1, longest + 1):
        of = np.array([sums.get((lang, n), (0, 1)) for lang in languages], np.float64)
        found, table = logs(rows.filter(pc.equal(rows.column("size"), n)), "gram", of[:, 0], of[:, 1])
        keys = found.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        gram_keys.append(keys[order])
        gram_logs.append(table[order])
    model = Model(languages, priors, index, word_logs, gram_keys, gram_logs)
    gram_totals = {n: [sums.get((lang, n), (0, 1)) for lang in languages] for n in range(1, longest + 1)}
    model.tables = (
        with_logs(words, ["word"], languages, F.lit(0), {0: list(zip(weight.tolist(), types.tolist()))}),
        with_logs(grams, ["size", "gram"], languages, F.col("size"), gram_totals),
    )
    return model


def with_logs(counts: DataFrame, keys: list[str], languages: list[str], kind: Column, totals: dict[int, list[tuple]]) -> DataFrame:
    """(keys, logs): log frequencies by language of counted keys, as the model holds them. totals: by kind
    of key the sum and the number of keys of each language."""
    own = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}") for i, lang in enumerate(languages)]

    def log(i: int) -> Column:
        whole = F.lit(None).cast("double")
        for k, of in totals.items():
            whole = F.when(kind == k, F.lit(float(of[i][0] + SMOOTHING * of[i][1]))).otherwise(whole)
        return F.log((F.col(f"n{i}") + SMOOTHING) / whole).cast("float").cast("double")

    return counts.groupBy(*keys).agg(*own).select(*keys, F.array(*[log(i) for i in range(len(languages))]).alias("logs"))


def split_ngrams(words: DataFrame, model: Model) -> DataFrame:
    """(word, k, sum, rest) of each word: its places, the summed logs of those whose longest n-gram workers
    hold, and of the other places (place, size, gram), from the longest down to the first that they hold."""
    shared = words.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("place", pa.int64()), ("size", pa.int32()), ("gram", pa.int64())]))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one = shared.value
            longest = len(one.grams)
            hashes, word = ngrams(batch.column("word").to_pylist(), longest)
            reach = (hashes != 0).sum(axis=0)
            held = np.zeros((longest, len(word)), bool)
            logs = np.zeros((len(word), len(one.languages)))
            for n in range(1, longest + 1):
                known = one.grams[n - 1]
                if not len(known):
                    continue
                at = np.minimum(np.searchsorted(known, hashes[n - 1]), len(known) - 1)
                held[n - 1] = (known[at] == hashes[n - 1]) & (hashes[n - 1] != 0)
                done = held[n - 1] & (reach == n)
                logs[done] = one.gram_logs[n - 1][at[done]]
            done = held[reach - 1, np.arange(len(word))]
            # The longest held: nothing shorter is asked for.
            most = np.where(held.any(axis=0), longest - held[::-1].argmax(axis=0), 0)
            wanted = (hashes != 0) & ~done & (np.arange(1, longest + 1)[:, None] >= most)
            place, size = np.nonzero(wanted.T)
            rest = pa.StructArray.from_arrays(
                [pa.array(place), pa.array((size + 1).astype(np.int32)), pa.array(hashes[size, place].view(np.int64))],
                fields=list(kind.value_type),
            )
            ends = segments(np.bincount(word[place], minlength=batch.num_rows))
            first = np.flatnonzero(np.diff(word, prepend=-1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word"),
                    pa.array(np.bincount(word, minlength=batch.num_rows)),
                    pa.array(list(np.add.reduceat(logs, first)), pa.list_(pa.float64())),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), rest),
                ],
                ["word", "k", "sum", "rest"],
            )

    return words.mapInArrow(
        split, "word string, k long, sum array<double>, rest array<struct<place: bigint, size: int, gram: bigint>>"
    )


def summed_logs(logs: str, weight: Column, n: int) -> Column:
    return F.array(*[F.sum(F.get(logs, F.lit(i)) * weight) for i in range(n)])


def missing_logs(words: DataFrame, model: Model) -> DataFrame:
    """(word, logs) of distinct words that the cache lacks: of the full table, or by their n-grams."""
    known, grams = model.tables
    n = len(model.languages)
    looked = settle(words.join(known, "word", "left"), "language-looked-up")
    split = settle(split_ngrams(looked.where(F.col("logs").isNull()).select("word"), model), "language-unseen")
    places = split.select("word", F.explode("rest").alias("r")).select("word", "r.*").join(grams, ["size", "gram"])
    place = places.groupBy("word", "place").agg(F.max_by("logs", "size").alias("logs"))
    more = place.groupBy("word").agg(summed_logs("logs", F.lit(1.0), n).alias("more"))
    total = F.when(F.col("more").isNull(), F.col("sum")).otherwise(F.zip_with("sum", "more", lambda x, y: x + y))
    backed = split.join(more, "word", "left").select("word", F.transform(total, lambda x: x / F.col("k")).alias("logs"))
    return settle(looked.where(F.col("logs").isNotNull()).unionByName(backed), "language-missing")


GUESS = "struct<lang: string, score: double>"


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with the predicted language and its score. The model's cache is sent to all workers."""
    guess, key = ("_".join([name, *docs.columns]) for name in ("guess", "key"))
    if model is None:
        return docs.withColumns({lang_pred: F.lit("und"), score: F.lit(0.0)})
    shared = SparkSession.active().sparkContext.broadcast(model)

    def cut(texts: list) -> Iterator[list]:
        start = size = 0
        for end, t in enumerate(texts, 1):
            size += len(t or "")
            if size > 1 << 21 or end == len(texts):
                yield texts[start:end]
                start, size = end, 0

    def lettered(texts: list) -> np.ndarray:
        return np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)

    def guesses(names: list[str], scores: list[np.ndarray], none: np.ndarray | None = None) -> pa.Array:
        flat = np.concatenate(scores) if scores else np.zeros(0)
        mask = None if none is None else pa.array(none)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(flat)], ["lang", "score"], mask=mask)

    @arrow_udf(GUESS)
    def cached(texts: pa.Array) -> pa.Array:
        """Of the texts whose words are all held; null for the others."""
        names, scores, none = [], [], []
        for some in cut(texts.to_pylist()):
            sums, counts, lacked = shared.value.sums(some)
            letters = lettered(some)
            got = shared.value.decide(sums, counts, letters)
            names += got[0]
            scores.append(got[1])
            none.append(np.array([bool(x) for x in lacked], bool) & letters)
        return guesses(names, scores, np.concatenate(none) if none else np.zeros(0, bool))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            at = 0
            for some in cut(batch.column("text").to_pylist()):
                sums, counts, lacked = shared.value.sums(some)
                keep = np.flatnonzero(np.array([bool(x) for x in lacked], bool) & lettered(some))
                met = [Counter(lacked[i]) for i in keep.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + at + keep),
                        batch.column("key").take(pa.array(at + keep)),
                        pa.array(list(sums[keep]), pa.list_(pa.float64())),
                        pa.array(counts[keep]),
                        pa.array([[{"word": w, "k": k} for w, k in m.items()] for m in met], met_type),
                    ],
                    ["row", "key", "sums", "n", "met"],
                )
                at += len(some)
            row += batch.num_rows

    met_type = pa.list_(pa.struct([("word", pa.string()), ("k", pa.int64())]))
    # A result belongs to the text. Other columns are in the key only to spread copies of one text.
    flat = [F.col(f"`{c}`").cast("string") for c, t in docs.dtypes if c != text_col and not t.startswith(("map", "array", "struct"))]
    of = F.concat(F.md5(F.col(text_col).cast("binary")), F.hex(F.pmod(F.xxhash64(*flat), F.lit(4096)))) if flat else F.md5(F.col(text_col).cast("binary"))
    asked = docs.select(of.alias("key"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    asked = settle(
        asked.mapInArrow(
            ask, "row long, key string, sums array<double>, n long, met array<struct<word: string, k: bigint>>"
        ),
        "language-asked",
    )
    met = asked.select("row", F.explode("met").alias("m")).select("row", "m.word", "m.k")
    logs = missing_logs(met.select("word").distinct(), model)
    width = len(model.languages)
    rest = met.join(logs, "word").groupBy("row").agg(summed_logs("logs", F.col("k"), width).alias("rest"))

    @arrow_udf(GUESS)
    def whole(sums: pa.Array, counts: pa.Array) -> pa.Array:
        table = np.array(sums.to_pylist(), np.float64).reshape(len(sums), width)
        names, scores = shared.value.decide(table, counts.to_numpy(), np.ones(len(table), bool))
        return guesses(names, [scores])

    added = F.transform(F.arrays_zip("sums", "rest"), lambda x: x["sums"] + x["rest"])
    others = settle(
        asked.join(rest, "row")
        .select(F.col("key").alias(key), whole(added, F.col("n")).alias(f"o{guess}"))
        .dropDuplicates([key]),
        "language-guessed",
    )
    guessed = docs.withColumns({guess: cached(F.col(text_col)), key: of}).join(others, key, "left")
    final = F.coalesce(f"`o{guess}`", f"`{guess}`")
    return (
        guessed.withColumn(guess, final)
        .withColumns({lang_pred: F.col(f"`{guess}`.lang"), score: F.col(f"`{guess}`.score")})
        .drop(guess, key, f"o{guess}")
    )
