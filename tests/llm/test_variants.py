"""Spelling variants against comparing all words, and the query against its definition."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import variants
from headway.llm.queries import QUERIES


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def expected(counts, ratio=10):
    """Near words by deleting a code point at every place, checked by definition."""
    holes = {}
    for w in counts:
        for i in range(len(w) + 1):
            holes.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    near = {w: set() for w in counts}
    for hole, some in holes.items():
        group = some | ({hole} & set(counts))
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, ns in near.items():
        best = min(ns, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items())


def counts_of(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sets(st.text("abé", min_size=1, max_size=6), min_size=1, max_size=25), min_size=1, max_size=4))
def test_near_rows(groups):
    rows = [(g, t) for g, group in enumerate(groups) for t in sorted(group)]
    lists_of, texts = np.array([g for g, _ in rows]), [t for _, t in rows]
    a, b = variants.near_rows(lists_of, texts, np.ones(len(rows), bool))
    want = {(i, j) for i, (g, s) in enumerate(rows) for j, (h, t) in enumerate(rows) if g == h and one_edit(s, t)}
    assert len(a) == len(want) and set(zip(a.tolist(), b.tolist())) == want


@pytest.mark.parametrize("longest", [2, 10, 4096])
def test_words_with_long_lists(spark, longest):
    """Lists cut down to two entries give what uncut ones give."""
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("abé"), rng.integers(7, 10))) for _ in range(400)}
    words |= {"prefixed" + "".join(rng.choice(list("xyz"), 3)) for _ in range(27)} | {"a" * 7, "a" * 8, "a" * 9}
    counts = {w: int(10 ** rng.integers(0, 5)) for w in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = variants.variants(df, longest=longest)
    assert sorted(map(tuple, got.collect())) == expected(counts)


def test_forms_lead_to_a_root(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "bbcdefg": 20, "unlike" * 2: 3}
    df = spark.createDataFrame(list(counts.items()) + [("abcdefg", 1)], "word string, n long")
    got = {r.word: r for r in variants.variants(df, ratio=5).collect()}
    assert got["abcdefg"].n == 3 and got["abcdefg"].form == "abcdefgh" and got["abcdefg"].n_near == 2
    assert {got[w].root for w in ("abcdefg", "abcdefgh", "abcdefghi", "abcdefghij")} == {"abcdefghij"}
    assert got["unlike" * 2].root == "unlike" * 2 and got["unlike" * 2].n_near == 0
    assert variants.variants(df.limit(0)).count() == 0


def test_query(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(120).collect()
    rows = [(d.doc_id, d.text) for d in docs]
    long = "x" * 30_000
    rows += [
        (10**6, "Überraschung überraschung Élevée élevée STRASSEN strassen straßenb straßenb"),
        (10**6 + 1, f"{long} {long}"),
        (10**6 + 2, f"{long}x {long}x abcdefg7hijklmn hijklmn"),
        (None, "abcdefg abcdefg"),
        (None, None),
        (10**6 + 6, "frequent " * 40 + "frequend frequend frequnt frequnt frequentt frequentt fraquent fraquent"),
        (10**6 + 3, ""),
        (10**6 + 4, "ababababab " * 40),
        *[(10**6 + 5, "repeated repeated")] * 3,
    ]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_spelling_variants"](spark, str(tmp_path))
    assert got.columns == "word form root n n_near form_n".split()
    want = expected(counts_of(rows))
    assert sorted(map(tuple, got.collect())) == want
    assert sum(w[1] is not None for w in want) > 3
