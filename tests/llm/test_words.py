"""Word hashes against splitting each text."""

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm.words import word_hashes


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from(" \t\nabAB\x0bé日.𝄞"), max_size=30)), max_size=8))
def test_words(texts):
    hashes, firsts = word_hashes(pa.array(texts, pa.string()))
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) for t in texts]
    assert [len(w) for w in words] == [b - a for a, b in zip(firsts[:-1], firsts[1:])]
    seen = {}
    for word, value in zip([w for ws in words for w in ws], hashes.tolist()):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_sliced_and_long():
    long = " ".join(["ab" * 700_000, "x", "ab" * 700_000])
    arr = pa.array(["skip", long, "x"]).slice(1)
    hashes, firsts = word_hashes(arr)
    assert firsts.tolist() == [0, 3, 4]
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3] != hashes[0]
