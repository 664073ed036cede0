"""The queries that SQL can express, against DuckDB."""

import os

import duckdb
import pytest

from headway.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    ours = QUERIES[name](spark, sf_dir)
    theirs = con.execute(ORACLES[name])
    names = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    left = sorted(tuple(map(repr, (r[n] for n in sorted(names)))) for r in ours.collect())
    at = [names.index(n) for n in sorted(names)]
    right = sorted(tuple(map(repr, (r[i] for i in at))) for r in theirs.fetchall())
    assert left and left == right


#: Queries that SQL cannot express, and the test that holds each against brute force, a round trip or
#: held-out accuracy.
TESTED = {
    "op1_bpe": "test_bpe.py",
    "op2_spotsigs": "test_spotsigs.py",
    "op3_packing": "test_packing.py",
    "op4_mixing": "test_mixing.py",
    "op7_pii": "test_pii.py",
    "op9_language_id": "test_language.py",
    "op10_trie_lm": "test_trie_lm.py",
    "op11_periodic_runs": "test_periodic.py",
    "op12_spelling_variants": "test_variants.py",
    "op13_html_extraction": "test_maintext.py",
}


def test_every_query_has_sql_or_a_test_of_its_own():
    folder = os.path.dirname(__file__)
    assert set(QUERIES) == set(ORACLES) | set(TESTED) and not set(ORACLES) & set(TESTED)
    for name, file in TESTED.items():
        with open(os.path.join(folder, file)) as f:
            assert f'"{name}"' in f.read(), name
