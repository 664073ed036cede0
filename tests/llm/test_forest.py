"""Near duplicates against brute force on groups of copies, near copies, chains and odd rows."""

import random

import duckdb

from headway.llm import forest
from headway.llm.components import components
from headway.llm.queries import ORACLES
from test_pipeline import brute_classes, shingles


def test_depths_meet_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        depths = forest.prefix_depths(threshold, 20, 8, 0.999)
        missed = 1.0
        for d in depths:
            missed *= 1 - threshold**d
        assert 1 - missed >= 0.999 and max(depths) - min(depths) <= 1


def test_groups(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    docs, n = {}, 0

    def add(words):
        nonlocal n
        docs[n] = " ".join(words)
        n += 1

    for _ in range(60):
        add([word() for _ in range(rng.randrange(1, 60))])
    base = [word() for _ in range(120)]
    for _ in range(90):  # one large group of near copies, over several blocks
        add([w if rng.random() > 0.01 else word() for w in base])
    chain = [word() for _ in range(100)]
    for _ in range(30):  # each like the one before, the ends unlike each other
        at = rng.randrange(100)
        chain = [*chain[:at], word(), *chain[at + 1 :]]
        add(chain)
    for _ in range(20):
        add(base)
    add(["One", "two"])
    add(["one", "TWO"])
    rows = [(i, t) for i, t in docs.items()]
    got = {r.doc_id: r for r in forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=16).collect()}
    sets = {i: shingles(t) for i, t in docs.items()}
    links = {i: sum(len(a & b) / len(a | b) >= 0.8 for j, b in sets.items() if j != i) for i, a in sets.items()}
    assert {i: r.n_links for i, r in got.items()} == links
    assert {i: r.class_id for i, r in got.items()} == brute_classes(docs)


def test_edges(spark):
    rows = [(4, None), (5, ""), (6, " \n"), (7, "same text here"), (9, "same text here"), (9, "same text here"), (None, "same text here"), (8, "w " * 30_000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, class_id int, nodes string")
    got = sorted(((r.doc_id or -1, r.class_id, r.n_links) for r in forest.near_duplicates(docs).collect()), key=str)
    assert got == sorted(
        [(4, 4, 0), (5, 5, 0), (6, 6, 0), (7, 7, 2), (9, 7, 2), (9, 7, 2), (-1, None, 0), (8, 8, 0)], key=str
    )
    assert forest.near_duplicates(docs.limit(0)).collect() == []


def test_rows_that_share_an_id(spark):
    rng = random.Random(7)
    a, b, c = ([f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(3))
    rows = [(5, a), (5, b), (2, [*a[:-1], "x"]), (3, [*b[:-1], "y"]), (5, a), (5, a), (1, c), (1, [*c, "z"]), (1, b)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in forest.near_duplicates(docs).collect())
    assert got == sorted([(5, 2, 3), (5, 2, 3), (5, 2, 3), (2, 2, 3), (5, 1, 2), (3, 1, 2), (1, 1, 2), (1, 1, 1), (1, 1, 1)])
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert sorted(con.execute(ORACLES["op5_jaccard_join"]).fetchall()) == got
    keyed = forest.near_duplicates(docs, keys=True).collect()
    assert {len({r.class_key for r in keyed if r.class_id == i}) for i in (1, 2)} == {1, 2}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(500, 500)]
    rng.shuffle(edges)
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r.id: r.component for r in components(frame).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert components(frame.limit(0)).collect() == []


def test_filter_passes_all_that_is_looked_for(spark):
    rows = spark.range(40_000).selectExpr("if(id % 50 = 49, null, id) doc_id", "id % 7 text_key", "cast(id as string) text")
    wanted = rows.where("doc_id % 10 = 3 or doc_id < 2").select("doc_id", "text_key")
    for most, passed in ((forest.FILTER_BITS, 6_000), (1 << 15, 12_000)):
        found = forest.among(rows, wanted, ["doc_id", "text_key"], most)
        assert found.columns == rows.columns
        assert found.join(wanted, ["doc_id", "text_key"]).count() == wanted.count()
        assert wanted.count() <= found.count() < passed
    assert forest.among(rows, wanted.limit(0), ["doc_id", "text_key"]).count() == 0


def test_texts_pass_the_filter_before_they_are_shuffled(spark, tmp_path, monkeypatch):
    texts = [f"{'a b c d e f g ' * (i % 3 + 1)}{i // 2} x" for i in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    plans, settle = {}, forest.settle

    def settled(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return settle(df, purpose)

    monkeypatch.setattr(forest, "settle", settled)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert forest.near_duplicates(spark.read.parquet(str(tmp_path / "docs"))).count() == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # From the scan of the texts upwards, the rows pass the bitmap before any shuffle; one shuffle takes them on.
    lines = plans["forest-verified"].splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "text" in line.split("Batched")[0])
    above = lines[:scan][::-1]
    assert next(line for line in above if "BroadcastHashJoin" in line or "Exchange hashpartitioning" in line).count("Join")
    assert sum("Exchange hashpartitioning" in line and "text_key" in line for line in lines) == 2
