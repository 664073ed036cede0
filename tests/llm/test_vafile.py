"""Exact search against brute force, and its edge cases."""

import random

from pyspark.sql import functions as F

from headway.llm import vafile

SCHEMA = "vec_id long, embedding array<float>"


def search(spark, rows, k, **options):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("kept out"))
    whole = frame.select("vec_id", vafile.integer_vector(F.col("embedding"), 64).alias("embedding"), "score")
    got = vafile.exact_top_k(whole, whole.where("vec_id % 5 = 0"), k, **options).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def brute(rows, k):
    ints = [
        (i, [int(64 * x // 1) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and abs(x) < float("inf") for x in v)
    ]
    out = {}
    for q, a in ints:
        if q % 5 == 0:
            scores = [(i, sum(x * y for x, y in zip(a, b))) for i, b in ints if i != q and len(b) == len(a)]
            best = sorted(scores, key=lambda s: (-s[1], s[0]))[:k]
            if best:
                out[q] = best
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-64, 64) / 64 for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # a hot vector: ties by id
    assert search(spark, rows, 7, part_rows=50, part_queries=20, bits=3) == brute(rows, 7)
    assert search(spark, rows, 7) == brute(rows, 7)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5]), (5, [0.25, -1.0]), (1, [1.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]),
        (10, [inf, 1.0]), (6, [1.0, 2.0, 3.0]), (15, [1.0, 1.0, 1.0]), (20, []), (None, [1.0, 1.0]),
    ]
    assert search(spark, rows, 3) == brute(rows, 3)
    large = [(0, [3e7, -2e7]), (1, [3e7, 2e7]), (2, [-3e7, 1.0])]
    assert search(spark, large, 2) == brute(large, 2)
    twice = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0])]
    assert search(spark, twice, 3) == {0: [(1, 2048), (1, 2048)]}
    assert search(spark, [(1, [1.0])], 3) == {}
    assert search(spark, rows[:0] or [(None, None)], 3) == {}
