"""Connected components of a graph of long ids, by stars that contract towards the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common


def _towards_least(edges: DataFrame) -> DataFrame:
    """Links everything next to u, and u, with the least of them. edges: (u, v), v beside u."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    # A node with very many neighbours is one key here; the engine splits it by itself.
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b); root is the smallest id it reaches.

    Each round makes every node point at the smallest id it sees, first among larger neighbours,
    then among smaller ones; the rounds grow with the logarithm of the graph. Every round is a
    stored table, so a lost executor repeats one round at most.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = common.stored(e.distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _towards_least(both)
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .distinct()
        )
        small = _towards_least(large).withColumn("end", F.explode(F.array("u", "v")))
        small = small.filter("end <> least").select(F.col("end").alias("u"), F.col("least").alias("v"))
        following = common.stored(small.distinct(), "edges")
        # Done when each node has one edge, to a node that has none of its own.
        more = following.groupBy("u").count().filter("count > 1").limit(1).count()
        chained = following.join(following.select(F.col("u").alias("v")), "v", "left_semi")
        e = following
        if not more and not chained.limit(1).count():
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
