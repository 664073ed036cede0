"""WARC records: round trips, and archives with faults."""

import hashlib

import pytest
from pyspark.sql import functions as F

from headway.llm import warc

SCHEMA = "page_id long, url string, html string"


def test_round_trip(spark):
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n\r\nWARC/1.1\r\n" + "é𝄞" * 30
    rows = [
        (1, "u1", "a" * 1500), (2, "u2", "a" * 1500), (9, "u9", "a" * 1500), (3, "u3", "small"), (4, "u4", "small"),
        (5, None, None), (6, "u6", ""), (None, "u7", "nobody"), (8, "u\r\n8", tricky), (10, "u10", "x" * 70_000),
        (3, "u3", "small"),
    ]
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit(1)).withColumn("payload", F.lit("x"))
    out = warc.round_trip(pages, segment_bytes=700, chunk_bytes=97, records_per_file=3).cache()
    assert out.where("fault is not null").count() == 0
    got = {(r.page_id, r.record_type): r for r in out.collect()}
    ids = {r.record_id: r.page_id for r in out.collect()}
    for i, _, html in rows:
        body = (html or "").encode()
        kind = "revisit" if i in (1, 2) else "response"
        r = got[(i, kind)]
        assert r.digest == hashlib.sha1(body).hexdigest()
        if kind == "revisit":
            assert ids[r.refers_to] == 9 and r.payload is None
        else:
            assert bytes(r.payload) == body and r.refers_to is None
    assert got[(5, "response")].url is None and got[(8, "response")].url == "u%0D%0A8"
    assert out.select("record_id").distinct().count() == out.count() == 11
    assert warc.round_trip(pages.limit(0)).count() == 0


def archive(tmp_path, records):
    (tmp_path / "a.warc").write_bytes(b"".join(r + warc.END for r in records))
    return str(tmp_path)


def test_segments_in_any_order_and_faults(spark, tmp_path):
    row = {"page_id": 1, "url": "u", "record_id": "urn:1", "refers_to": None, "payload": b"x" * 1000}
    row["digest"] = hashlib.sha1(row["payload"]).hexdigest()
    good = warc.page_records(row, 300, 64)
    assert len(good) > 3

    def read(records, name):
        (tmp_path / name).mkdir()
        return [(r.payload and bytes(r.payload), r.fault) for r in warc.read_archives(spark, archive(tmp_path / name, records)).collect()]

    assert read([good[2], good[0], *good[3:][::-1], good[1], good[1]], "shuffled") == [(row["payload"], None)]
    assert read(good[:1] + good[2:], "hole") == [(None, "segments missing")]
    assert read(good[:-1], "end") == [(None, "no total length")]
    wrong = good[-1].replace(b"Total-Length: ", b"Total-Length: 9")
    assert read([*good[:-1], wrong], "length") == [(None, "total length differs")]
    whole = warc.page_records(row, 10_000, 64)[0]
    assert read([whole.replace(b"\r\n40\r\n", b"\r\nzz\r\n", 1)], "framing") == [(None, "framing")]
    assert read([whole.replace(b"xxx", b"xyx", 1)], "digest") == [(row["payload"].replace(b"xxx", b"xyx", 1), "digest differs")]


@pytest.mark.parametrize("data", [b"junk", b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort", b"WARC/1.1\r\nWARC-Type: x\r\n\r\n"])
def test_broken_archives_are_told(data):
    assert [r["fault"] is not None for r in warc.parse(data)] == [True]


def test_plain_bodies_are_left_alone():
    assert warc.unchunk(b"HTTP/1.1 200 OK\r\n\r\nbody") == b"body"
    assert warc.unchunk(b"HTTP/1.1 200 OK") is None


def test_the_query_has_a_row_for_each_page_row(spark, tmp_path):
    """Repeated rows, small and large, and equal payloads of other pages; against the query's SQL."""
    import duckdb

    from headway.llm.queries import ORACLES, QUERIES

    large = "long page " * 5000
    rows = [(1, "u1", large)] * 3 + [(2, "u2", large)] * 2 + [(3, "u3", "small")] * 4 + [(4, "u4", ""), (5, "u5", None)]
    rows += [(6, "u6", "y" * 1200), (7, "u6", "y" * 1200)] * 2 + [(8, "u8", "z" * 2000)] * 2500
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["op6_warc"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    theirs = con.execute(ORACLES["op6_warc"])
    names = [c[0] for c in theirs.description]
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, theirs.fetchall()))
    assert got.count() == len(rows) and got.where("refers_to = 2 and page_id = 1").count() == 3


def test_of_two_equal_payloads_one_is_a_revisit(spark):
    """Whichever of the two record ids, which are hashes, is the smaller one."""
    rows = [(2 * pair + i, f"u{i}", f"{pair} " * 600) for pair in range(20) for i in range(2)]
    out = warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    ids = {r.record_id: r.page_id for r in out}
    found = sorted((r.page_id, r.record_type, ids.get(r.refers_to)) for r in out)
    assert found == [(i, *(("response", None) if i % 2 else ("revisit", i + 1))) for i in range(40)]
