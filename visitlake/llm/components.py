"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.common import fewer, stored

#: Edges in one file of a round, at least, if there are as many.
EDGES_AT_ONCE = 50_000


def _linked_to_smallest(edges: DataFrame) -> DataFrame:
    """Every neighbour that is larger than ``u`` is tied to the smallest of ``u`` and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node on an edge; the component is its smallest node.

    Alternates the large-star and the small-star step until the edges no longer change:
    a number of rounds that grows with the logarithm of the nodes, each two joins on the
    edge table. No neighbour list is collected; a node with many edges is a skewed join key,
    which adaptive execution splits. Each round is written and read again, in as many files as
    its edges need: they never become more. Self-loops and nulls are ignored.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current, before = stored(fewer(edges, both.count(), EDGES_AT_ONCE)), None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                current.select("v", "v").distinct())
        before = mark
        undirected = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _linked_to_smallest(undirected).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        tied = _linked_to_smallest(large)
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(tied.select("u", F.col("m").alias("v")))
        current = stored(fewer(small.filter("u > v").distinct(), mark[0], EDGES_AT_ONCE))
