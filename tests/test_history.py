import dataclasses
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from headway.operators.history import (
    VALID_FROM,
    VALID_TO,
    VERSION_ID,
    SnapshotSpec,
    apply_changes,
    as_of,
    first_snapshot,
    scd2,
    version_id,
    with_ids,
    without_ids,
)
from headway.plans.snapshots import read_as_of, read_snapshot, take_snapshot

SPEC = SnapshotSpec("snapshot_thing", "id", ("name", "lat"))
T = [dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in range(1, 6)]
STATES = [
    [(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)],
    [(1, "a", 1.0), (2, "B", 2.0), (3, "c", 3.0), (4, "d", 4.0)],
    [(2, "B", 2.0), (3, "c", None), (4, "d", 4.0)],
    [(1, "a", 1.0), (2, "B", 2.0), (3, "c", None), (4, "d", 4.0)],
]


def state(spark, i):
    df = spark.createDataFrame(STATES[i], "id int, name string, lat double")
    return df.withColumn("ingested_at", F.lit(T[i]).cast("timestamp")).select(SPEC.columns)


def at(i):
    return F.lit(T[i]).cast("timestamp")


def day(stamp):
    return stamp and stamp.day


def summary(history):
    return sorted(
        ((r.id, r.name, r.lat, day(r[VALID_FROM]), day(r[VALID_TO])) for r in history.collect()),
        key=lambda r: (r[0], r[3]),
    )


EXPECTED = [
    (1, "a", 1.0, 1, None),
    (2, "b", 2.0, 1, 2),
    (2, "B", 2.0, 2, None),
    (3, "c", None, 1, 2),
    (3, "c", 3.0, 2, 3),
    (3, "c", None, 3, None),
    (4, "d", 4.0, 2, None),
]


def history_of(spark, runs):
    history = first_snapshot(state(spark, 0), "id", at(0))
    for i in range(1, runs):
        history = scd2(history, state(spark, i), "id", SPEC.check, at(i))
    return history


def test_changes_new_and_vanished_keys(spark):
    assert summary(history_of(spark, 4)) == EXPECTED


def test_unchanged_input_changes_nothing(spark):
    before = history_of(spark, 3)
    after = scd2(before, state(spark, 2), "id", SPEC.check, at(3))
    assert before.exceptAll(after).count() == after.exceptAll(before).count() == 0


def test_random_changes_against_a_plain_model(spark):
    rng = random.Random(7)
    states = [
        {k: (rng.choice("ab"), rng.choice([None, 0.0, 1.0])) for k in range(60) if rng.random() < 0.8}
        for _ in range(5)
    ]
    history, expected = None, []
    for i, now in enumerate(states):
        df = spark.createDataFrame([(k, *v) for k, v in now.items()], "id int, name string, lat double")
        current = df.withColumn("ingested_at", at(i)).select(SPEC.columns)
        history = (
            first_snapshot(current, "id", at(0)) if i == 0 else scd2(history, current, "id", SPEC.check, at(i))
        )
        for k, v in now.items():
            held = next((r for r in expected if r[0] == k and r[4] is None), None)
            if held is None or (held[1], held[2]) != v:
                if held is not None:
                    held[4] = i + 1
                expected.append([k, *v, i + 1, None])
    assert summary(history) == sorted(map(tuple, expected), key=lambda r: (r[0], r[3]))


def test_ingested_at_is_carried_but_not_compared(spark):
    rows = {r.id: r for r in history_of(spark, 4).where(F.col(VALID_TO).isNull()).collect()}
    assert rows[1].ingested_at.day == 1 and rows[4].ingested_at.day == 2


def test_versions_are_told_apart_and_do_not_overlap(spark):
    rows = history_of(spark, 4).collect()
    assert len({r[VERSION_ID] for r in rows}) == len(rows)
    for key in {r.id for r in rows}:
        spans = sorted((r[VALID_FROM], r[VALID_TO]) for r in rows if r.id == key)
        assert [end for _, end in spans[:-1]] == [start for start, _ in spans[1:]]
        assert spans[-1][1] is None


def test_as_of_includes_the_start_and_excludes_the_end(spark):
    history = history_of(spark, 4)
    assert {(r.id, r.name, r.lat) for r in as_of(history, at(0)).collect()} == set(STATES[0])
    assert {(r.id, r.name, r.lat) for r in as_of(history, at(1)).collect()} == set(STATES[1])
    assert as_of(history, F.lit("2023-12-31").cast("timestamp")).count() == 0


def test_kept_history(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        read_snapshot(spark, root, SPEC)
    for i in range(4):
        take_snapshot(spark, root, SPEC, state(spark, i), T[i])
    kept = read_snapshot(spark, root, SPEC)
    assert summary(kept) == EXPECTED
    assert kept.columns == history_of(spark, 2).columns


def test_a_run_taken_again_changes_nothing_and_none_goes_back(spark, tmp_path):
    root = str(tmp_path)
    take_snapshot(spark, root, SPEC, state(spark, 0), T[1])
    before = summary(read_snapshot(spark, root, SPEC))
    take_snapshot(spark, root, SPEC, state(spark, 1), T[1])
    assert summary(read_snapshot(spark, root, SPEC)) == before
    with pytest.raises(ValueError):
        take_snapshot(spark, root, SPEC, state(spark, 1), T[0])


def test_a_repeated_key_is_refused_before_anything_is_written(spark, tmp_path):
    root = str(tmp_path)
    twice = state(spark, 0).unionByName(state(spark, 0))
    with pytest.raises(ValueError, match="repeats"):
        take_snapshot(spark, root, SPEC, twice, T[0])
    assert not list(tmp_path.iterdir())
    take_snapshot(spark, root, SPEC, state(spark, 0), T[0])
    files = sorted(tmp_path.rglob("*.parquet"))
    with pytest.raises(ValueError, match="repeats"):
        take_snapshot(spark, root, SPEC, twice, T[1])
    assert sorted(tmp_path.rglob("*.parquet")) == files


def test_equal_rows_add_no_versions(spark, tmp_path):
    root = str(tmp_path)
    for moment in T[:3]:
        take_snapshot(spark, root, SPEC, state(spark, 0), moment)
    assert read_snapshot(spark, root, SPEC).count() == state(spark, 0).count()


def test_snapshots_can_be_repeated_after_one_of_them_failed(spark, tmp_path, monkeypatch):
    from headway.plans import snapshots

    specs = {n: dataclasses.replace(SPEC, name=f"snapshot_{n}") for n in ("a", "b", "c")}
    monkeypatch.setattr(snapshots, "SNAPSHOTS", specs)
    root, good = str(tmp_path), state(spark, 0)
    bad = good.unionByName(good)
    with pytest.raises(ValueError):
        snapshots.snapshot_dimensions(spark, root, {"a": good, "b": bad, "c": good}, T[0])
    snapshots.snapshot_dimensions(spark, root, {"a": good, "b": good, "c": good}, T[0])
    for spec in specs.values():
        assert read_snapshot(spark, root, spec).count() == good.count()


def test_a_run_without_commit_is_invisible(spark, tmp_path):
    root = str(tmp_path)
    take_snapshot(spark, root, SPEC, state(spark, 0), T[0])
    kept = read_snapshot(spark, root, SPEC).collect()
    leftovers = spark.createDataFrame(kept, read_snapshot(spark, root, SPEC).schema)
    for part in ("open", "closed"):
        leftovers.write.parquet(f"{root}/{SPEC.name}/versions/version=v2024-dead/state={part}/bucket=0")
    assert summary(read_snapshot(spark, root, SPEC)) == EXPECTED[:1] + [
        (2, "b", 2.0, 1, None), (3, "c", None, 1, None),
    ]
    take_snapshot(spark, root, SPEC, state(spark, 1), T[1])
    assert read_snapshot(spark, root, SPEC).count() == 6


def many(spark, n, salt=0, changed=()):
    """n rows of which those whose id is in `changed` differ by `salt`."""
    name = F.when(F.col("id").isin(*changed), F.lit(f"new {salt}")).otherwise(F.concat(F.lit("n"), "id"))
    df = spark.range(n).select(F.col("id").cast("int").alias("id"), name.alias("name"), F.lit(1.0).alias("lat"))
    return df.withColumn("ingested_at", F.lit(T[salt]).cast("timestamp"))


def files_of(tmp_path):
    return {str(f.relative_to(tmp_path)): f.stat().st_size for f in tmp_path.rglob("*.parquet")}


def test_an_unchanged_dimension_writes_one_marker_row(spark, tmp_path):
    root = str(tmp_path)
    take_snapshot(spark, root, SPEC, many(spark, 1000), T[0], rows_per_bucket=100)
    before = files_of(tmp_path)
    # Another order, another partitioning and another stamp are no change.
    again = many(spark, 1000, 1).repartition(5, "name").orderBy(F.desc("id"))
    take_snapshot(spark, root, SPEC, again, T[1], rows_per_bucket=100)
    new = {f: size for f, size in files_of(tmp_path).items() if f not in before}
    assert len(new) == 1 and next(iter(new)).startswith("snapshot_thing/commits/") and sum(new.values()) < 4096
    assert spark.read.parquet(f"{root}/{next(iter(new))}").count() == 1
    assert read_snapshot(spark, root, SPEC).where(F.col(VALID_FROM) == at(0)).count() == 1000


def test_only_changed_buckets_are_written(spark, tmp_path):
    root = str(tmp_path)
    take_snapshot(spark, root, SPEC, many(spark, 1000), T[0], rows_per_bucket=100)
    assert len({f.split("bucket=")[1].split("/")[0] for f in files_of(tmp_path) if "bucket=" in f}) == 16
    take_snapshot(spark, root, SPEC, many(spark, 1000, 1, (7,)), T[1], rows_per_bucket=100)
    new = [f for f in files_of(tmp_path) if "/versions/version=v20240102" in f]
    assert len({f.split("bucket=")[1].split("/")[0] for f in new}) == 1
    kept = read_snapshot(spark, root, SPEC)
    assert kept.count() == 1001 and kept.where("id = 7").count() == 2
    # One of the other buckets' keys goes, and comes back as it was: its version stays open.
    gone = many(spark, 1000, 1, (7,)).where("id <> 8")
    take_snapshot(spark, root, SPEC, gone, T[2], rows_per_bucket=100)
    take_snapshot(spark, root, SPEC, many(spark, 1000, 1, (7,)), T[3], rows_per_bucket=100)
    assert summary(read_snapshot(spark, root, SPEC)) == summary(kept)


def test_null_and_value_trading_places_is_a_change(spark, tmp_path):
    root, spec = str(tmp_path), SnapshotSpec("s", "id", ("a", "b"))
    rows = [("x", None), (None, "x")]
    for (a, b), moment in zip(rows, T):
        df = spark.createDataFrame([(1, a, b)], "id int, a string, b string").withColumn("ingested_at", at(0))
        take_snapshot(spark, root, spec, df, moment)
    assert read_snapshot(spark, root, spec).count() == 2


def test_a_dimension_that_outgrows_its_buckets_is_dealt_anew(spark, tmp_path):
    root = str(tmp_path)
    take_snapshot(spark, root, SPEC, many(spark, 100), T[0], rows_per_bucket=100)
    take_snapshot(spark, root, SPEC, many(spark, 90, 1, (3,)), T[1], rows_per_bucket=100)
    grown = many(spark, 900, 1, (3,)).where("id < 50 or id >= 60")
    take_snapshot(spark, root, SPEC, grown, T[2], rows_per_bucket=100)
    kept = read_snapshot(spark, root, SPEC)
    assert kept.count() == 901 and kept.where(F.col(VALID_TO).isNull()).select("id").distinct().count() == 900
    take_snapshot(spark, root, SPEC, many(spark, 900, 1, (3,)), T[3], rows_per_bucket=100)
    assert summary(read_snapshot(spark, root, SPEC)) == summary(kept)
    assert len(spark.read.parquet(f"{root}/snapshot_thing/commits").where("bucket is null").collect()) == 4


def test_as_of_leaves_out_runs_that_had_closed_before(spark, tmp_path):
    root = str(tmp_path)
    months = [dt.datetime(2022 + m // 12, m % 12 + 1, 1, tzinfo=dt.timezone.utc) for m in range(8)]
    for m, moment in enumerate(months):
        rows = spark.createDataFrame([(i, f"{i} {m // (i + 1)}", 0.0) for i in range(4)], "id int, name string, lat double")
        take_snapshot(spark, root, SPEC, rows.withColumn("ingested_at", at(0)).select(SPEC.columns), moment)
    whole = read_snapshot(spark, root, SPEC)
    for moment in (months[0], months[3], months[3] + dt.timedelta(days=3), months[7], dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc)):
        got = read_as_of(spark, root, SPEC, moment)
        assert summary(got) == summary(as_of(whole, F.lit(moment).cast("timestamp")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan


def test_ids_of_versions_in_several_buckets_and_packed_files(spark, tmp_path):
    """Ids are made after the rows were gathered by bucket: those of their key and start, held ones as they were."""
    import pyarrow.parquet as pq

    root = str(tmp_path)
    take_snapshot(spark, root, SPEC, many(spark, 200), T[0], rows_per_bucket=50)
    first = {r.id: r[VERSION_ID] for r in read_snapshot(spark, root, SPEC).collect()}
    assert first == {r.id: r[VERSION_ID] for r in first_snapshot(many(spark, 200), "id", at(0)).collect()}
    take_snapshot(spark, root, SPEC, many(spark, 201, 1, (7,)), T[1], rows_per_bucket=50)
    rows = read_snapshot(spark, root, SPEC).collect()
    assert len({r[VERSION_ID] for r in rows}) == len(rows) == 202
    assert {r.id: r[VERSION_ID] for r in rows if day(r[VALID_FROM]) == 1} == first
    assert {r.id for r in rows if day(r[VALID_FROM]) == 2} == {7, 200}
    files = [f for f in tmp_path.rglob("*.parquet") if "/versions/" in str(f)]
    assert {pq.read_metadata(f).row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_ids_are_left_out_of_shuffles_unless_they_are_others(spark):
    history = spark.sql(
        "select * from values (1, 'a', timestamp'2024-01-01 00:00:00.000001'), (2, 'b', timestamp'2024-01-02 00:00:00'), "
        "(3, 'c', null), (cast(null as int), 'd', timestamp'2024-01-02 00:00:00') t(k, x, dbt_valid_from)"
    ).withColumn("dbt_valid_to", F.lit(None).cast("timestamp"))
    own = history.withColumn("dbt_scd_id", version_id(F.col("k"), F.col("dbt_valid_from")))
    other = F.when(F.col("k") == 1, "theirs").when(F.col("k") != 2, F.col("dbt_scd_id"))
    mixed = own.withColumn("dbt_scd_id", other)
    ids = lambda df: [r.dbt_scd_id for r in df.orderBy("x").collect()]
    assert ids(without_ids(own, "k")) == [None] * 4
    assert [r and r.dbt_scd_id for r in ids(without_ids(mixed, "k"))][:2] == ["theirs", None]
    assert without_ids(mixed, "k").where("dbt_scd_id is null").count() == 1
    for rows in (own, mixed):
        assert ids(with_ids(without_ids(rows, "k"), "k")) == ids(rows)
        seen = rows.select("k", "x").where("k is not null")
        kept = apply_changes(rows, seen, "k", ["x"], F.lit("2024-02-01").cast("timestamp"))
        assert ids(kept) == ids(rows) and kept.schema["dbt_scd_id"].dataType.simpleString() == "string"
