"""The pipeline stage by stage, and on awkward rows."""

import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from headway.llm import mixing, pii
from headway.llm.queries import VOCABULARY
from headway.llm.shared import settle


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_classes(docs):
    """Least id of all documents that links of similarity 0.8 lead to."""
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in docs if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small >= 0.8 * large and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in docs}


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def test_columns(outputs):
    assert all(o.columns == outputs[0].columns for o in outputs[:-1])


def test_language_keeps_clean_documents(outputs):
    before = {r.doc_id: r for r in outputs[0].collect()}
    after = {r.doc_id: r for r in outputs[1].collect()}
    assert len(after) >= 0.99 * len(before) and all(before[i] == r for i, r in after.items())


def test_near_duplicates(outputs):
    before = {r.doc_id: r.text for r in outputs[1].collect()}
    classes = brute_classes(before)
    assert sorted(r.doc_id for r in outputs[2].collect()) == sorted(set(classes.values()))


def test_near_duplicates_of_rows_that_share_an_id(spark, sf_dir):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a, "s", 1), (1, b, "s", 2), (1, a, "s", 3), (2, f"{a} x", "s", 4), (3, f"{b} x", "s", 5), (1, "", "s", 6), (None, a, "s", 7), (None, a, "s", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key string, class_key long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert got.columns == docs.columns
    kept = [rows[i] for i in (0, 1, 5, 6, 7)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, kept))


def test_pii(outputs):
    before = {r.doc_id: r for r in outputs[2].collect()}
    after = {r.doc_id: r for r in outputs[3].collect()}
    assert set(before) == set(after)
    changed = 0
    for i, r in after.items():
        assert not [s for s in pii.candidates(r.text) if s["base"]]
        assert r.n_chars == len(r.text)
        if not pii.candidates(before[i].text):
            assert r.text == before[i].text
        changed += r.text != before[i].text
    assert changed


def test_mixing(spark, outputs):
    before = {tuple(r) for r in outputs[3].collect()}
    after = [tuple(r) for r in outputs[4].collect()]
    assert set(after) <= before and len(after) == len(set(after))
    want = mixing.mix(outputs[3], corpus_pipeline.MIX_POWER, budget=corpus_pipeline.MIX_BUDGET)
    assert sorted(r[0] for r in after) == sorted(r.doc_id for r in want.where("sampled").collect())


def test_tokens(outputs):
    theirs = Tokenizer.from_file(VOCABULARY)
    text = {r.doc_id: r.text for r in outputs[4].collect()}
    rows = outputs[5].collect()
    assert sorted(text) == sorted(r.doc_id for r in rows)
    for r in rows:
        assert r.token_ids == theirs.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.token_ids)


def test_awkward_rows(spark, sf_dir):
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30)
    more = spark.createDataFrame(
        [(None, "the and of to in a is that", "en", None, None), (1005, None, None, None, 3), (1007, "", "en", "s", 0), (1008, "the " * 20_000, "en", "s", 1), (1008, "the " * 20_000, "en", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs = base.unionByName(more)
    for extra in ("spans", "token_ids", "score", "lang_pred", "class_id", "topic"):
        docs = docs.selectExpr("*", f"'kept' as {extra}")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = settle(stage(spark, docs, sf_dir), "test-awkward")
        assert docs.columns == columns and docs.where("spans <> 'kept' or topic <> 'kept'").count() == 0
    ids = [r.doc_id for r in docs.collect()]
    assert 1005 not in ids and 1007 not in ids and ids.count(1008) <= 1
    corpus_pipeline.encode(spark, docs, sf_dir).collect()


def test_empty(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
