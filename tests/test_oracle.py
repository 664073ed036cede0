"""Every query against its SQL in DuckDB."""

import math

import duckdb
import pytest

from headway.catalogue.oracles import oracle_sql
from headway.catalogue.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return repr(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir)
    theirs = duck.execute(oracle_sql()[name])
    kinds = {c[0]: str(c[1]) for c in theirs.description}
    assert {c: TYPES[t] for c, t in ours.dtypes} == kinds
    order = sorted(kinds)
    at = [list(kinds).index(c) for c in order]
    left = sorted(tuple(comparable(r[c]) for c in order) for r in ours.collect())
    right = sorted(tuple(comparable(r[i]) for i in at) for r in theirs.fetchall())
    assert left and left == right
