"""Days that are replaced at once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.operators.latest import newest_day
from headway.sources import staging
from headway.sources.staging import StagedTable, convert_staged, stage_table
from headway.sources.tables import raw_path, replace_partitions
from headway.sources.versions import (
    folders_in_force,
    in_force,
    read_days,
    replace_all_at_once,
    replace_day_at_once,
    superseded,
)

D = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def rows(spark, *triples):
    return spark.createDataFrame([(i, n, D[d]) for i, n, d in triples], "id int, name string, partition_date date")


def held(spark, path):
    return sorted((r.id, r.name, r.partition_date.day) for r in read_days(spark, path).collect())


def breaking(df):
    """The same rows, of which the last cannot be made: some have been written by then."""
    return df.withColumn("name", F.when(F.col("id") < 9, F.col("name")).otherwise(F.raise_error(F.lit("lost"))))


@pytest.fixture
def path(spark, tmp_path):
    p = str(tmp_path / "t")
    replace_all_at_once(rows(spark, (1, "a", 0), (2, "b", 1), (3, "c", 1)), p)
    return p


def test_a_day_is_replaced_and_the_others_stay(spark, path):
    assert held(spark, path) == [(1, "a", 1), (2, "b", 2), (3, "c", 2)]
    replace_day_at_once(rows(spark, (4, "d", 1)), path, "2024-01-02")
    replace_day_at_once(rows(spark, (5, "e", 2)), path, "2024-01-03")
    assert held(spark, path) == [(1, "a", 1), (4, "d", 2), (5, "e", 3)]
    assert read_days(spark, path).columns == ["id", "name", "partition_date"]
    assert read_days(spark, path).schema["partition_date"].dataType.simpleString() == "date"


def test_an_emptied_day(spark, path):
    replace_day_at_once(rows(spark, (1, "x", 1)).limit(0), path, "2024-01-02")
    assert held(spark, path) == [(1, "a", 1)] and newest_day(spark, path) == D[0]


def test_the_whole_table_is_replaced(spark, path):
    replace_day_at_once(rows(spark, (4, "d", 1)), path, "2024-01-02")
    # It may read what it replaces.
    replace_all_at_once(read_days(spark, path).where("partition_date > '2024-01-01'").withColumn("name", F.lit("z")), path)
    assert held(spark, path) == [(4, "z", 2)]
    replace_day_at_once(rows(spark, (7, "g", 0)), path, "2024-01-01")
    assert held(spark, path) == [(4, "z", 2), (7, "g", 1)]


@pytest.mark.parametrize("day", [None, "2024-01-02"])
def test_a_write_that_fails_half_way_leaves_the_table_as_it_was(spark, path, day):
    before = held(spark, path)
    state = in_force(spark, path)
    reader = read_days(spark, path)
    bad = breaking(rows(spark, *((i, "n", 1) for i in range(1, 10)))).repartition(9, "id")
    with pytest.raises(Exception, match="lost"):
        if day is None:
            replace_all_at_once(bad, path)
        else:
            replace_day_at_once(bad, path, day)
    assert held(spark, path) == before and in_force(spark, path) == state
    replace_day_at_once(rows(spark, (8, "new", 1)), path, "2024-01-02")
    assert held(spark, path) == [(1, "a", 1), (8, "new", 2)]
    # A reader that started before the commit still finds what it listed.
    assert sorted(r.id for r in reader.collect()) == [1, 2, 3]


def test_all_written_but_not_committed_is_invisible(spark, path, monkeypatch):
    from headway.sources import versions

    def dies(*_, **__):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(versions, "_commit", dies)
    with pytest.raises(RuntimeError):
        replace_day_at_once(rows(spark, (4, "d", 1)), path, "2024-01-02")
    assert held(spark, path) == [(1, "a", 1), (2, "b", 2), (3, "c", 2)]
    assert superseded(spark, path) == []


def test_only_folders_in_force_are_listed(spark, path):
    for i in range(3):
        replace_day_at_once(rows(spark, (i, "x", 1)), path, "2024-01-02")
    folders = folders_in_force(spark, path)
    assert list(folders) == ["2024-01-01", "2024-01-02"]
    files = read_days(spark, path).inputFiles()
    assert files and all(any(f"{folder}/" in f for folder in folders.values()) for f in files)
    assert len(superseded(spark, path)) == 2
    plan = read_days(spark, path).where(F.col("partition_date") == D[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan


def test_rows_without_a_day(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None), (2, D[0])], "id int, partition_date date")
    replace_all_at_once(df, p)
    assert sorted((r.id, r.partition_date) for r in read_days(spark, p).collect()) == [(1, None), (2, D[0])]
    assert newest_day(spark, p) == D[0]
    with pytest.raises(ValueError):
        read_days(spark, str(tmp_path / "none"))


def test_staging_a_day_that_fails_still_reads_the_old_day(spark, tmp_path, monkeypatch):
    """Staging, merging and converting alike: what was staged before stays readable."""
    raw, root = str(tmp_path / "raw"), str(tmp_path / "staging")
    lines = StagedTable("lines", "endpoint", "lines")
    landed = spark.createDataFrame([("L1", '["a"]', "20240101"), ("L2", '["b"]', "20240102")], "id string, municipality_ids string, partition_date string")
    replace_partitions(landed, raw_path(raw, "endpoint", "lines"))
    stage_table(spark, raw, root, lines, F.lit("2024-01-03").cast("timestamp"))
    convert_staged(spark, root, "lines")
    stage = staging.stage
    monkeypatch.setattr(staging, "stage", lambda *a: stage(*a).withColumn("id", F.raise_error(F.lit("lost")).cast("string")))
    monkeypatch.setattr(staging, "json_to_array", lambda df, _: df.withColumn("id", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        stage_table(spark, raw, root, lines, day="20240102")
    with pytest.raises(Exception, match="lost"):
        convert_staged(spark, root, "lines", D[1])
    for table in ("lines", "lines_converted"):
        staged = staging.read_staged(spark, root, table).orderBy("id").collect()
        assert [(r.id, r.partition_date) for r in staged] == [("L1", D[0]), ("L2", D[1])]
