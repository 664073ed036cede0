"""Personal data: base matches against the stated patterns, voting, edge cases."""

import re

import numpy as np
from hypothesis import example, given, settings
from hypothesis import strategies as st

from headway.llm import pii
from headway.llm.queries import QUERIES


def brute(text):
    """The base matches as stated, by plain regular expressions."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and check(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    }
    return [(k, *m.span()) for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m[0])]


def check(digits):
    doubled = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


ALPHABET = st.sampled_from(list("aB1250.@+-_ ()é%") + ["4111111111111111", "a@b.co", "+1 (336) 555-3810", "1.2.3.4"])


@settings(max_examples=500, deadline=None)
@example(["1.2.3.4", ".", "1.2.3.4", ".", "9"])
@example(["a@", "a@b.co", "@b.co", ".", "a@b.co"])
@given(st.lists(ALPHABET, max_size=25))
def test_base(parts):
    text = "".join(parts)
    got = [(x["kind"], x["start"], x["end"]) for x in pii.candidates(text) if x["base"]]
    assert got == brute(text)


def test_long_runs_are_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000 + "x", "+1" + " " * 300_000):
        pii.candidates(text)


def test_em_learns_reliability():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.4
    right = [0.95, 0.9, 0.6]
    marks = np.stack([np.where(rng.random(len(truth)) < r, truth, ~truth) * 2 - 1 for r in right], axis=1)
    patterns, at, counts = np.unique(marks, axis=0, return_inverse=True, return_counts=True)
    share, reliability = pii.expectation_maximisation(np.zeros(len(patterns), int), patterns, counts.astype(float))
    assert np.allclose(reliability[:, 1, 2], right, atol=0.05)
    assert ((share[at.ravel()] > 0.5) == truth).mean() > 0.93


def test_looser_spans(spark):
    rows = [(i, f"please call 0{i % 10}12 555 12{i % 90 + 10:02d} or write to jo [at] site{i} [dot] com today") for i in range(40)]
    rows += [(100 + i, f"mail me{i}@x{i}.org or call +1 (336) 555-38{i:02d}, card 4111 1111 1111 1111") for i in range(40)]
    rows += [(200 + i, f'token="{i:016d}" order #{i}12-345-6789 total $12345678901234{i % 10}{i // 10}') for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs, pii.train(docs)).collect()}
    kinds = [sorted(s.kind for s in got[i]) for i in range(40)]
    assert all(k == ["email", "phone"] for k in kinds)
    assert all([s.kind for s in got[i] if s.base] == ["email", "card", "phone"] for i in range(100, 140))
    assert not [s for i in range(200, 240) for s in got[i] if not s.base]
    text = rows[40][1]
    assert pii.mask(text, [s.asDict() for s in got[100]]) == "mail <EMAIL> or call <PHONE>, card <CARD>"


def test_edges(spark):
    odd = [(1, None, "x"), (2, "", "x"), (3, "a@b.co", "x"), (3, "a@b.co", "x"), (None, "né a@b.co", "x")]
    docs = spark.createDataFrame(odd, "doc_id long, text string, spans string")
    out = pii.find(docs, pii.train(docs))
    assert out.columns == ["doc_id", "text", "spans"]
    assert [[(s.start, s.end) for s in r.spans] for r in out.collect()] == [[], [], [(0, 6)], [(0, 6)], [(3, 9)]]
    assert pii.train(docs.limit(0)) == {} and pii.find(docs.limit(0), {}).count() == 0
    assert pii.find(docs.where("text is null"), {}).collect()[0].spans == []


def test_query(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op7_pii"](spark, sf_dir).collect()}
    import hashlib

    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        want = brute(d.text or "")
        got = rows[d.doc_id]
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [got[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x[0] == k for x in want) for k in pii.BASE_KINDS]
        assert set(text.split(",")) - {""} <= set(got.spans.split(","))
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
