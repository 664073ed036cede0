"""Mixing against proportional fitting in numpy."""

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from headway.llm import mixing
from headway.llm.queries import MIX_POWER, QUERIES
from headway.llm.shared import settle


def brute(rows, power, budget):
    """Weights by cell and scale, by sweeps over a dense table."""
    cells = defaultdict(float)
    for r in rows:
        cells[(r.source, r.lang, r.topic)] += r.n_tokens
    cells = {k: v for k, v in cells.items() if v}
    axes = [sorted({k[i] for k in cells}) for i in range(3)]
    x = np.zeros([len(a) for a in axes])
    for k, v in cells.items():
        x[tuple(a.index(c) for a, c in zip(axes, k))] = v
    w = x.copy()
    for _ in range(500):
        for i, name in enumerate(("source", "lang", "topic")):
            rest = tuple(j for j in range(3) if j != i)
            want = x.sum(axis=rest) ** power[name]
            want = want / want.sum() * x.sum()
            shape = [-1 if j == i else 1 for j in range(3)]
            w = w * (want / w.sum(axis=rest)).reshape(shape)
    weight = np.divide(w, x, out=np.zeros_like(w), where=x > 0)
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if (np.minimum(1, mid * weight) * x).sum() < budget * x.sum() else (low, mid)
    return {k: weight[tuple(a.index(c) for a, c in zip(axes, k))] for k in cells}, low


def test_query(spark, sf_dir):
    got = QUERIES["op4_mixing"](spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in got) == sorted(docs)
    weights, scale = brute(got, MIX_POWER, 0.5)
    for r in got:
        assert r.n_tokens == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        assert abs(r.weight / weights[(r.source, r.lang, r.topic)] - 1) < 1e-4
        assert abs(r.probability - min(1, r.weight * scale)) < 1e-4
    whole = sum(r.n_tokens for r in got)
    assert abs(sum(r.n_tokens * r.probability for r in got) / whole - 0.5) < 1e-4
    drawn = sum(r.n_tokens for r in got if r.sampled) / whole
    assert 0.3 < drawn < 0.7 and all(r.sampled for r in got if r.probability == 1)


def test_given_targets(spark):
    rows = [(i, "a b c d", "en" if i % 4 else "fr", f"s{i % 3}") for i in range(400)]
    docs = settle(mixing.described(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")), "t")
    fit = mixing.rake(docs, {"source": 1.0, "topic": 1.0}, {"lang": {"en": 0.5, "fr": 0.5}}, budget=0.4)
    out = mixing.with_probabilities(docs, fit, seed=3)
    shares = {r.lang: r.x for r in out.groupBy("lang").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("x")).collect()}
    assert abs(shares["en"] / shares["fr"] - 1) < 1e-4
    assert out.where("sampled").exceptAll(mixing.with_probabilities(docs, fit, seed=3).where("sampled")).count() == 0


def test_topics_and_edges(spark):
    rows = [
        (1, "a | b | c", None, None),
        (2, "STOP!! NOW!!", "en", "s"),
        (3, None, "en", "empty"),
        (4, "", "en", "empty"),
        (5, "plain words only " * 2000, "en", "s"),
        (5, "plain words only " * 2000, "en", "s"),
        (None, "x = {y};", "de", "s"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("topic", F.lit("x")).withColumn("weight", F.lit(1))
    got = mixing.mix(docs, MIX_POWER).collect()
    assert len(got) == 7
    topics = {(r.doc_id, r.topic, r.source) for r in got}
    assert {(1, "tabular", "(none)"), (2, "emphatic", "s"), (5, "general", "s"), (None, "code", "s")} <= topics
    assert all(r.weight == 0 and not r.sampled for r in got if r.source == "empty")
    same = [r for r in got if r.doc_id == 5]
    assert same[0] == same[1]
    assert mixing.mix(docs.limit(0), MIX_POWER).collect() == []
    assert [r.sampled for r in mixing.mix(docs.where("doc_id = 3"), MIX_POWER).collect()] == [False]
