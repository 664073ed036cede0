"""BPE against the public library that defines the files, and round trips."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import bpe
from headway.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


CASES = [
    "",
    " \n\t ",
    "Hello, World's   2024 tests!!",
    "ΑΣ ΟΔΟΣ İstanbul ǅ ß ﬁ é  x y",
    "a\x1cb\x1f c\x85d",
    "<|startoftext|>Hi <|endoftext|><|endoftext|> <|STARTOFTEXT|>",
    "x" * 5000 + "🎉🎉" * 50,
    "日本語 テキスト 12345 ½ ² Ⅷ",
    "don't we'll I'M 's're",
]


@pytest.mark.parametrize("text", CASES)
def test_cases(theirs, text):
    one = bpe.codec(PATH)
    ids = list(memoryview(one.encode(text)).cast("i")) if one.encode(text) else []
    want = theirs.encode(text, add_special_tokens=False).ids
    assert ids == want
    assert one.decode(ids) == theirs.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text(text):
    one = bpe.codec(PATH)
    got = one.encode(text)
    ids = list(memoryview(got).cast("i")) if got else []
    assert ids == Tokenizer_once().encode(text, add_special_tokens=False).ids


_kept = []


def Tokenizer_once():
    if not _kept:
        _kept.append(Tokenizer.from_file(PATH))
    return _kept[0]


def test_columns(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "The quick brown fox", "c"), (3, "The quick brown fox", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "token_ids", "decoded"]
    got = {(r.doc_id, tuple(r.token_ids), r.decoded) for r in out.collect()}
    fox = Tokenizer_once().encode("The quick brown fox").ids
    assert got == {(1, (), ""), (2, (), ""), (3, tuple(fox), Tokenizer_once().decode(fox))}
    assert out.count() == 4
    assert bpe.encode(docs.limit(0), PATH).collect() == []
    odd = spark.createDataFrame([(None,), ([10**6],)], "token_ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, PATH).collect()] == ["", ""]


def test_the_query_against_the_library(spark, sf_dir, tmp_path, theirs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [(d.doc_id, d.text) for d in docs]
    rows += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n"), (10**6 + 3, "x" * 20_000), (None, "no id"), (None, "no id")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    theirs.no_padding()
    theirs.no_truncation()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = []
    for (doc_id, text), found in zip(rows, theirs.encode_batch([t or "" for _, t in rows], add_special_tokens=False), strict=True):
        decoded = theirs.decode(found.ids, skip_special_tokens=False)
        want.append((doc_id, len(found.ids), sha(" ".join(map(str, found.ids))), sha(decoded)))
    got = QUERIES["op1_bpe"](spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
