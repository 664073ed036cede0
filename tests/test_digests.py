"""Digests that other engines compute as well: same rows, same text; any other value, another."""

import duckdb

from headway.operators.digests import portable_digest

SCHEMA = "name string, n bigint, x double, flag boolean"
ROWS = [("a", 1, 0.1, True), ("b", None, 1e9, False), (None, -5, -0.000002, None), ("é\x00|", 7, None, True)]


def digest(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.agg(portable_digest(df.schema).alias("d")).first().d


def test_order_does_not_count_but_rows_and_values_do(spark):
    whole = digest(spark, ROWS)
    assert whole == digest(spark, ROWS[::-1])
    assert whole != digest(spark, [*ROWS, ROWS[0]]) and whole != digest(spark, ROWS[1:])
    for i, other in enumerate(("", 2, 0.100001, None)):
        changed = list(ROWS[0])
        changed[i] = other
        assert digest(spark, [tuple(changed), *ROWS[1:]]) != whole


def test_values_do_not_run_into_each_other(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("abc", None), (None, "abc")], "a string, b string")
    found = df.groupBy("a", "b").agg(portable_digest(df.schema).alias("d"))
    assert found.select("d").distinct().count() == 4


def test_nothing_has_no_digest(spark):
    assert digest(spark, []) is None


def test_duckdb_agrees(spark):
    rows = [r for r in ROWS if "\x00" not in (r[0] or "")]
    values = duckdb.connect().execute(
        """select cast(sum(cast('0x' || substr(md5(concat_ws(chr(31), coalesce(s, chr(30)), coalesce(n::varchar, chr(30)),
                  coalesce(floor(x * 1000000)::bigint::varchar, chr(30)), coalesce(f::varchar, chr(30)))), 1, 15) as bigint))
                  as varchar)
           from (select unnest(?) s, unnest(?) n, unnest(?) x, unnest(?) f)""",
        [list(c) for c in zip(*rows, strict=True)],
    ).fetchone()
    assert values[0] == digest(spark, rows)


def test_groups(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = {r.flag: r.d for r in df.groupBy("flag").agg(portable_digest(df.schema).alias("d")).collect()}
    assert found[True] == digest(spark, [ROWS[0], ROWS[3]])
