"""Language identification: backoff, edge cases, held-out accuracy."""

import numpy as np
from pyspark.sql import functions as F

from headway.llm import language
from headway.llm.queries import QUERIES

ROWS = [
    (1, "the cat and the dog", "en"),
    (2, "der Hund und die Katze", "de"),
    (3, "the house, THE dog!", "en"),
    (4, "die Straße über Öl", "de"),
    (5, None, "en"),
    (6, "ignored", None),
    (7, "ignored", " "),
]
SCHEMA = "doc_id long, text string, lang string"


def test_counts_and_backoff(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    counts = {(r.lang, r.word): r.n for r in language.count_words(docs, "text", "lang").collect()}
    assert counts[("en", "the")] == 4 and counts[("en", "dog")] == 2 and counts[("de", "über")] == 1
    assert ("en", "ignored") not in counts
    model = language.train(docs)
    assert model.languages == ["de", "en"]
    # A word of the vocabulary: (count + 1/2) / (all + types / 2).
    total, types = (sum(n for (lang, _), n in counts.items() if lang == "en"), sum(lang == "en" for lang, _ in counts))
    want = np.log(4.5 / (total + types / 2))
    assert abs(model.word_logs[model.words["the"]][1] - want) < 1e-5
    # An unseen word: the longest known n-gram at each place, by brute force.
    def brute(word, lang):
        grams = {}
        for (one, w), n in counts.items():
            marked = f"\x01{w}\x02"
            for end in range(1, len(marked) + 1):
                for size in range(1, min(end, language.LONGEST) + 1):
                    key = (one, size, marked[end - size : end])
                    grams[key] = grams.get(key, 0) + n
        marked, logs = f"\x01{word}\x02", []
        for end in range(1, len(marked) + 1):
            for size in range(min(end, language.LONGEST), 0, -1):
                gram = marked[end - size : end]
                if any((x, size, gram) in grams for x in model.languages):
                    of = [n for (x, k, _), n in grams.items() if x == lang and k == size]
                    logs.append(np.log((grams.get((lang, size, gram), 0) + 0.5) / (sum(of) + 0.5 * len(of))))
                    break
            else:
                logs.append(0.0)
        return np.mean(logs)

    for word in ("thedog", "hundx", "qqq", "ö"):
        got = model.unseen([word])[0]
        assert np.allclose(got, [brute(word, "de"), brute(word, "en")], atol=1e-4)


def test_edges(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    model = language.train(docs)
    odd = [(1, None, "x"), (2, "", "x"), (3, "12 !? 3", "x"), (4, "the dog " * 50_000, "x"), (4, "日本語", "x"), (None, "und die", "x")]
    out = language.identify(spark.createDataFrame(odd, "doc_id long, text string, score string"), model)
    assert out.columns == ["doc_id", "text", "score", "lang_pred"]
    got = [(r.doc_id, r.lang_pred, r.score) for r in out.collect()]
    assert [g[1] for g in got[:4]] == ["und", "und", "und", "en"] and got[5][1] == "de"
    assert got[4][1] in ("de", "en") and all(0 <= g[2] <= 1 for g in got)
    assert [g[2] for g in got[:3]] == [0.0, 0.0, 0.0]
    none = language.train(docs.where("lang = 'x'"))
    assert none is None
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_the_bounds_change_no_result(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").limit(60)
    texts = [(i, t, "") for i, t in enumerate(["the hund qqq", "über dogged straßen", "die", None, "12", "the hund qqq"])]
    asked = docs.unionByName(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    rows = docs.unionByName(spark.createDataFrame(ROWS, SCHEMA))

    def results(**bounds):
        got = language.identify(asked, language.train(rows, **bounds)).collect()
        return sorted((r.doc_id, r.text or "", r.lang, r.lang_pred, round(r.score, 5)) for r in got)

    assert results(max_words=8, max_ngrams=8) == results()
    # Words of the full table by their own frequency, the others by all n-grams.
    model = language.train(rows, max_words=8, max_ngrams=8)
    whole = language.train(rows)
    words = ["katze", "thedog", "hundx", "öqq"]
    assert len(model.words) < len(whole.words) and "katze" not in model.words
    logs = {r.word: r.logs for r in language.missing_logs(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    assert np.allclose(logs["katze"], whole.word_logs[whole.words["katze"]], atol=1e-5)
    for w in words[1:]:
        assert np.allclose(logs[w], whole.unseen([w])[0], atol=1e-4)


def test_held_out_accuracy(spark, sf_dir):
    got = QUERIES["op9_language_id"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got.count() == docs.count()
    right = got.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.97
