"""Connected components of a stored edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtide.llm.common import spread_join
from railtide.session import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect the larger (or the smaller) neighbours of every node to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    kept = both.where("b > a" if large else "b < a")
    linked = spread_join(kept, least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        linked = linked.unionByName(least.select("a", F.col("m").alias("b")))
    return linked.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """The smallest reachable node of every node with an edge.

    ``edges`` (a, b) long; direction, repeated edges, loops and edges with a null do not matter.
    Returns node, component. Every round is written to the shared folder, which cuts lineage. The
    number of rounds grows with the logarithm of the longest path.
    """
    current = store(edges.where("a <> b").select("a", "b").distinct(), "edges")
    signature = None
    while True:
        current = store(_star(store(_star(current, True), "edges"), False), "edges")
        found = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == signature:
            break
        signature = tuple(found)
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
