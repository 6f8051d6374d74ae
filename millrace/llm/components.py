"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.workspace import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Rows (a, b), a < b: each node's larger (else its smaller) neighbours are hung on the smallest of them and itself.

    Grouping gives a number per node; a node's neighbours are never gathered.
    """
    both = edges.unionByName(edges.select(F.col("a").alias("b"), F.col("b").alias("a")))
    near = both if large else both.where("b < a")
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to"))
    moved = near.join(least, "a")
    if large:
        # No more rows than edges; repeated ones go with the next step.
        return moved.where("b > a AND to < b").select(F.col("to").alias("a"), "b")
    # The node itself is hung on its smallest neighbour, like the others.
    moved = moved.select(F.col("to").alias("a"), "b").unionByName(least.select(F.col("to").alias("a"), F.col("a").alias("b")))
    return moved.where("a < b").distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that is no one's larger end; ``edges`` are distinct, a < b."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("below")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(1).alias("below"))
    )
    # Of each node the edges to smaller ones, and whether it has others.
    nodes = ends.groupBy("node").agg(F.sum("below").alias("down"), F.min("below").alias("least"))
    return not nodes.agg(F.count(F.when(F.expr("down > 1 OR down = 1 AND least = 0"), 1))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """From rows (a, b) to rows (node, component): every node with the smallest one it reaches.

    A large-star step hangs the larger neighbours of every node on the smallest node near it, a small-star step the smaller ones
    and the node itself; both keep what is connected, and no step makes more edges than there were. Long paths are
    folded, so rounds grow with the logarithm of the nodes, not with the longest path. They end when every node has one
    edge, to a node that is no one's larger end. Each round is written to the shared folder; the plan of a round starts there.
    Loops and repeated edges count once, and a node has one row however many edges it has.
    """
    loops = edges.where("a = b").select(F.col("a").alias("node")).distinct()
    left, _ = stored(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while not _is_done(left):
        left, _ = stored(_stars(_stars(left, large=True), large=False), "edges")
    roots = left.select(F.col("a").alias("node")).distinct()
    found = left.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        roots.unionByName(loops.join(left.select(F.col("b").alias("node")), "node", "left_anti")).distinct()
        .select("node", F.col("node").alias("component"))
    )
    return found
