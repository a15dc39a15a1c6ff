"""Connected components of a graph of any size, as joins and groupings.

Alternating star contraction: every node links its larger neighbours, then
its smaller ones, to the smallest it knows, until the edges form stars. The
number of rounds grows with the logarithm of the nodes, not with the diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.session import written

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): the smallest node it reaches.

    ``u`` and ``v`` are longs that are not null; loops and repeats are ignored.
    Each round is written to the shared folder, so a lost executor costs one round.
    """

    def settled(df: DataFrame) -> DataFrame:
        return written(df.filter("u <> v").distinct(), "edges")

    def summary(df: DataFrame):
        mark = F.xxhash64("u", "v").cast("decimal(38,0)")
        return df.agg(F.count("*"), F.sum(mark)).first()

    edges = settled(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    )
    before = summary(edges)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        edges = settled(_small_star(_large_star(edges)))
        after = summary(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v"), F.col("v")).distinct().toDF("node", "root"))
