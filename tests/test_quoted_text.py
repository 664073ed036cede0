"""Quoted text with line breaks, read by many tasks."""

import csv
import io
import random

import pytest

from headway.schemas import columns
from headway.sources.landing import read_gtfs_text

SCHEMA = columns("a string, b string, c string")


def written(path, rows, end="\n", header="a,b,c"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    path.write_bytes((header + end + out.getvalue()).encode())


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few dozen bytes: line breaks lie across every border."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "40b")
    spark.conf.set(names[1], "1b")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def read(spark, path):
    return sorted((tuple(r)[:3] for r in read_gtfs_text(spark, str(path), SCHEMA, multi_line=True).collect()), key=repr)


def one_task(spark, path):
    """What Spark reads of a file in one piece."""
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
    return sorted((tuple(r) for r in spark.read.options(**options).csv(str(path)).collect()), key=repr)


PIECES = ["x", "é", 'say "hi"', "two\nlines", "\n\n", ",", '"', '"\n"', "a" * 120, "plain text", "\n" + "long\n" * 30]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_text_over_any_ranges(spark, tmp_path, small_ranges, seed, end):
    rng = random.Random(seed)
    folder = tmp_path / "t.txt"
    folder.mkdir()
    for f in range(3):
        rows = [("".join(rng.choices(PIECES, k=rng.randint(1, 3))), str(i), rng.choice(["", "z"])) for i in range(25)]
        written(folder / f"{f}.txt", rows, end)
    got = read(spark, folder)
    assert got == one_task(spark, folder) and len(got) == 75
    text = spark.read.text(str(folder / "0.txt"), lineSep="\n")
    assert text.rdd.getNumPartitions() > 20


def test_only_broken_records_are_shuffled(spark, tmp_path):
    written(tmp_path / "t.txt", [(str(i), "one\ntwo" if i == 500 else "x", "y") for i in range(1000)])
    df = read_gtfs_text(spark, str(tmp_path / "t.txt"), SCHEMA, multi_line=True)
    assert df.count() == 1000 and df.where("b = 'one\ntwo'").count() == 1
    assert {r[0] for r in df.select("_source_file").distinct().collect()} == {"t.txt"}


def test_blank_lines_empty_files_and_empty_fields(spark, tmp_path):
    folder = tmp_path / "t.txt"
    folder.mkdir()
    (folder / "1.txt").write_text('a,b,c\n\n1,"",\n\n2,"p\n\nq",3\n\n')
    (folder / "2.txt").write_text("a,b,c")
    got = read_gtfs_text(spark, str(folder), SCHEMA, multi_line=True).collect()
    assert sorted((tuple(r)[:3] for r in got), key=repr) == one_task(spark, folder)


@pytest.mark.parametrize(
    ("text", "told"),
    [
        ('a,b,c\n1,"open,3\n2,3,4\n', "MALFORMED"),
        ('a,b,c\n1,"x\ny",3,4\n', "MALFORMED|Malformed"),
        ('a,b,c\n1,"x\ny"\n', "MALFORMED|Malformed"),
    ],
)
def test_what_cannot_be_read_stops_the_read(spark, tmp_path, text, told):
    (tmp_path / "t.txt").write_text(text)
    with pytest.raises(Exception, match=told):
        read(spark, tmp_path / "t.txt")


def test_another_header_stops_the_read(spark, tmp_path):
    folder = tmp_path / "t.txt"
    folder.mkdir()
    written(folder / "1.txt", [("1", "x\ny", "3")])
    written(folder / "2.txt", [("1", "x\ny", "3")], header="b,a,c")
    with pytest.raises(Exception, match="another header"):
        read(spark, folder)
