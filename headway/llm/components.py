"""Connected components of a graph given as edges, by alternating large and small stars.

Each round ties the neighbours of a node to the least of them; the edges end as stars around the
least node of each component, after a number of rounds that grows with the logarithm of its size.
The least neighbours are written before they are joined back: both sides of that join then come from
shuffles, and adaptive execution splits the partition of a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.shared import settle


def _least(edges: DataFrame) -> DataFrame:
    return settle(edges.groupBy("u").agg(F.min("v").alias("least")), "least")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("least", F.least("u", "least"))
    large = settle(
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(),
        "large-star",
    )
    least = _least(large)
    small = large.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return settle(small.unionByName(least.withColumnRenamed("least", "v")).distinct(), "small-star")


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of long ids to (id, component): the least id that can be reached.

    Only nodes of an edge between two different ones are returned; the least of a component is
    among them. No edges: no rows.
    """
    oriented = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = settle(oriented.distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        now = _round(now)
    root = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(root)
