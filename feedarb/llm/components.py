"""Connected components of a graph given by its edges.

Alternating large-star and small-star steps: each turns edges towards the smallest known
neighbour, by one aggregation and one equi-join, until nothing changes and every edge
leads to the smallest node of its component.  Nodes with very many edges are aggregated
map-side and their join is split by adaptive execution.  Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedarb.plans.storage import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """(u > v) becomes (u, smallest node around v)."""
    ways = edges.select(F.col("v").alias("n"), F.col("u").alias("o")).union(edges.select("u", "v"))
    least = ways.groupBy("n").agg(F.min("o").alias("m")).select("n", F.least("n", "m").alias("m"))
    return edges.join(least, edges["v"] == least["n"]).select("u", F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are all tied to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where(F.col("v") != F.col("m"))
    return (
        tied.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node it is joined to, for all nodes with edges.

    Edges may come twice and in either direction.  Those from a node to itself or without
    an end count for nothing; a graph without edges has no rows.
    """
    current = durable(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        following = durable(_small_star(_large_star(current)), "edges")
        reached = _state(following)
        current, done = following, reached == state
        state = reached
        if done:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
