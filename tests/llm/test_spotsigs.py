"""SpotSigs against a plain reading of the rules."""

import hashlib

import regex
from pyspark.sql import functions as F

from headway.llm import spotsigs
from headway.llm.queries import QUERIES


def brute(text, chain=3, step=1):
    """Signatures as tuples of words."""
    words = regex.findall(r"[\p{L}\p{N}]+", text.lower())
    common = set(spotsigs.ANCHORS)
    out = set()
    for i, w in enumerate(words):
        if w in common:
            later = [x for x in words[i + 1 :] if x not in common]
            links = later[: (chain - 1) * step + 1 : step]
            if len(links) == chain:
                out.add((w, *links))
    return out or {(w,) for w in words} or {("", text)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_query(spark, sf_dir):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    rows = {r.doc_id: r for r in QUERIES["op2_spotsigs"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    seen = {}
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        r = rows[i]
        k = len(text) // 4
        edited = text[: len(text) - k] + following[:k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = brute(text), brute(edited), brute(following)
        assert abs(r.near_edited - jaccard(a, b)) < 1e-9 and abs(r.near_next - jaccard(a, c)) < 1e-9
        assert len(r.fingerprint) == 8 * len(a) and len(r.edited_fingerprint) == 8 * len(b)
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
    assert sum(r.near_edited for r in rows.values()) / len(rows) > 0.5


def test_edges(spark):
    long = "the house and garden of many trees " * 5000
    rows = [(5, "b", 1), (None, "zero", 1), (3, None, 1), (3, None, 1), (9, long, 1), (7, "", 1), (2**60, "the end of it all now", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, signatures int")
    got = spotsigs.edited_likeness(docs).collect()
    order = sorted(((-1 if i is None else i), t or "") for i, t, _ in rows)
    want = sorted((t[: len(t) - len(t) // 4] + n[: len(t) // 4]) for (_, t), (_, n) in zip(order, order[1:] + order[:1]))
    assert sorted(r.edited for r in got) == want
    assert all(0 <= r.near_edited <= 1 and r.near_next is not None for r in got)
    assert spotsigs.edited_likeness(docs.limit(0)).collect() == []
    one = spotsigs.edited_likeness(docs.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_next_over_many_buckets(spark):
    ids = sorted({i * i % 1013 * (10**9 if i % 7 == 0 else 1) + i for i in range(3000)})
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in spotsigs.with_next(docs, ["text"], rows_per_bucket=7).collect()}
    order = sorted(ids)
    assert got == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}


def test_near_pairs(spark):
    sets = {i: set(range(i * 100, i * 100 + 40 + i % 3)) for i in range(6)}
    sets |= {10 + i: set(range(500, 540)) - set(range(500, 500 + i)) for i in range(12)}
    sets |= {30: sets[1] | {9999}, 31: {1}, 32: {1}, 33: {1, 2}}
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "doc_id long, signatures array<int>")
    got = {(min(r.left_id, r.right_id), max(r.left_id, r.right_id)) for r in spotsigs.near_pairs(frame).collect()}
    least = {}
    for i in sorted(sets):
        least.setdefault(frozenset(sets[i]), i)
    ids = sorted(least.values())
    assert got == {(a, b) for a in ids for b in ids if a < b and jaccard(sets[a], sets[b]) >= 0.8}


def test_plan_is_native(spark, sf_dir):
    plan = QUERIES["op2_spotsigs"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
