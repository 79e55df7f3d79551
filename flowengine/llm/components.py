"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowengine.llm.common import materialised


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of an edge its component's smallest node.

    `edges` has two non-null long columns a and b. Rounds of two steps bring every node next to
    its root: first each node's larger neighbours move to its smallest neighbour, then its
    smaller ones do. A star is what both leave alone; the number of rounds grows with the
    logarithm of the longest path. Each round is written to the shared folder. A step is an
    aggregation and a join on a node; where one node has most of the edges, the aggregation
    combines them before the shuffle and Spark splits the join's partition. No edges, no rows.
    """
    stars = materialised(_smaller_first(edges), "edges")
    while True:
        moved = _small_star(_large_star(stars))
        after = materialised(moved, "edges")
        if _digest(after) == _digest(stars):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        stars = after


def _smaller_first(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, each once, no loops."""
    ends = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    return ends.distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its smallest neighbour, or to itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")).toDF("a", "b"))
    least = both.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("nearest"))
    least = least.select("hub", F.least("hub", "nearest").alias("nearest"))
    # edges run from larger to smaller, so the hub is the smaller end and a the larger neighbour
    moved = edges.join(least, edges["b"] == least["hub"]).select("a", F.col("nearest").alias("b"))
    return _smaller_first(moved)


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("nearest"))
    moved = edges.join(least, edges["a"] == least["hub"])
    return _smaller_first(
        moved.select(F.col("b").alias("a"), F.col("nearest").alias("b")).union(
            least.select(F.col("hub").alias("a"), F.col("nearest").alias("b"))
        )
    )


def _digest(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, and all but surely only for these."""
    mixed = F.xxhash64("a", "b")
    return tuple(
        edges.agg(
            F.count("*"), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 20)),
        ).first()
    )
