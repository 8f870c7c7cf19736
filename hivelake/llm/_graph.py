"""Connected components of a graph too large for one machine, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import remove, written


def components(edges: DataFrame) -> DataFrame:
    """``(v, component)`` for every vertex of ``edges(a, b)``; a component is named by its smallest vertex.

    Each round points every vertex at its smallest neighbour, follows the pointers twice, and keeps the
    edges between different targets.  Vertices of a component at least halve, so the rounds are few.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    edges = written(edges.select(a.alias("a"), b.alias("b")).where("a < b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not rounds or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = written(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("p")), "near")
        up = near.select(F.col("v").alias("p"), F.col("p").alias("q"))
        once = near.join(up, "p").select("v", F.col("q").alias("p"))
        twice = written(once.join(up, "p").select("v", F.col("q").alias("p")), "parents")
        rounds.append(twice)
        ends = twice.select(F.col("v").alias("a"), F.col("p").alias("pa")), twice.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        left = edges.join(ends[0], "a").join(ends[1], "b").where("pa <> pb")
        left = left.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        done, edges = edges, written(left, "edges")
        remove(done, near)
    out = rounds.pop()
    for before in reversed(rounds):
        later = out.select(F.col("v").alias("p"), F.col("p").alias("q"))
        out = before.join(later, "p", "left").select("v", F.coalesce("q", "p").alias("p"))
    out = written(out.withColumnRenamed("p", "component"), "components")
    remove(edges)
    return out
