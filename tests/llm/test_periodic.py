"""Periodic runs against trying every period at every place, and the query against its definition."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import periodic
from headway.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, extra string"


def every_run(words, repeats=4, least=6):
    """Maximal stretches of each period, kept where no smaller period has the same extent."""
    n, out = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(words, runs):
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def edited(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = edited(doc_id, words_of(text))
    runs = every_run(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
        sha(collapsed(words, runs)),
    )


def result(texts):
    return periodic._found(pa.array(texts, pa.string())).to_pylist()


def check(texts):
    for text, row in zip(texts, result(texts), strict=True):
        words = words_of(text)
        runs = every_run(words)
        assert [tuple(r.values()) for r in row["runs"]] == runs
        assert row["collapsed"] == collapsed(words, runs)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab ", max_size=60)), max_size=6))
def test_small_alphabets(texts):
    check([t and " ".join(t) for t in texts])


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_planted_periods(data):
    seed = data.draw(st.integers(0, 2**32 - 1))
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(data.draw(st.integers(1, 4))):
        words = []
        for _ in range(data.draw(st.integers(0, 3))):
            period = rng.integers(0, data.draw(st.sampled_from([2, 5, 1000])), data.draw(st.integers(1, 90)))
            words += np.resize(period, int(len(period) * data.draw(st.floats(1, 7)))).tolist()
            words += rng.integers(0, 50, data.draw(st.integers(0, 20))).tolist()
        texts.append(" ".join(f"w{w}" for w in words))
    check(texts)


def test_awkward_texts():
    check(["", None, " \t\n", "a", "a " * 5, "a " * 6, "x " * 3000, "É é " * 9, "A a " * 4, "a b " * 7])
    assert result([]) == []


def test_every_scale_finds_a_run_of_exactly_four_periods():
    rng = np.random.default_rng(5)
    texts, want = [], []
    for p in [15, 16, 17, 31, 32, 33, 63, 64, 127, 128, 255, 1023, 1024, 2500]:
        words = [f"w{x}" for x in rng.permutation(9 * p).tolist()]
        texts.append(" ".join(words[: p - 1] + words[p : 2 * p] * 4 + words[2 * p :]))
        want.append([{"start": p - 1, "length": 4 * p, "period": p}])
    assert [r["runs"] for r in result(texts)] == want
    # And none of a word less.
    short = [" ".join(t.split()[: p["start"] + p["length"] - 1]) for t, (p,) in zip(texts, want)]
    assert [r["runs"] for r in result(short)] == [[]] * len(short)


def test_a_long_text():
    rng = np.random.default_rng(1)
    words = [f"w{x}" for x in rng.integers(0, 200_000, 400_000)]
    words[100_000:180_000] = (words[:20_000]) * 4
    (row,) = result([" ".join(words)])
    assert [r["period"] for r in row["runs"]] == [20_000]
    assert len(row["collapsed"].split()) == 400_000 - 3 * 20_000


def test_operator_keeps_rows_and_columns(spark):
    rows = [(1, "a " * 8, "x"), (1, "a " * 8, "x"), (2, None, None), (None, "", "y")]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("extra", "runs")
    out = periodic.with_runs(df)
    assert out.columns == ["doc_id", "text", "runs", "collapsed"]
    got = sorted((r.doc_id or 0, len(r.runs), r.collapsed) for r in out.collect())
    assert got == [(0, 0, ""), (1, 1, "a"), (1, 1, "a"), (2, 0, "")]
    assert periodic.with_runs(df.limit(0)).count() == 0


def test_query(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [(d.doc_id, d.text) for d in docs]
    # Ids that the edit applies to, with awkward texts, repeated rows and nulls.
    ids = [i for i in range(10**6, 10**6 + 400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    texts = ["", None, "one", "a b c d e f g h", "x " * 50, " \n", "b a " * 33, "é ü", "q w e r t z " * 5, "A", "a a", "k l m"]
    rows += [*zip(ids, texts), (ids[3], texts[3]), (None, "a " * 7), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    want = [expected(*r) for r in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[1] for w in want) > 5
