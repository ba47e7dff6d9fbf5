"""Connected components of a large graph, with DataFrames.

Alternating large-star and small-star steps: every edge is replaced by an
edge to the smallest known neighbour until each component is a star around
its smallest node. Minima are pre-aggregated before the shuffle, the edges
return by a join that can be split where one node has very many edges, and
each round is written to the shared folder, so no lineage builds up. The
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from immolens.llm.tables import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (linked.unionByName(least.select("a", F.col("m").alias("b")))
            .where(F.col("a") != F.col("b")).distinct())


def _digest(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns a, b): the
    smallest node that it is connected with. Loops and repeated edges do no
    harm; edges with a null end are ignored."""
    edges = stored(edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))), "edges")
    seen = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "star")
        now = _digest(edges)
        if now == seen or not now[0]:
            break
        seen = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
