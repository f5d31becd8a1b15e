"""Connected components of an edge table, by alternating large and small stars.

Every round is two grouped minima and joins back (no node's neighbours are
collected), so a hub of any degree is fine; the edges are cut to a table in
the shared folder after each round. Rounds grow with the logarithm of the
longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.session import cut_lineage, discard_cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its least neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from larger to smaller: link a node's smaller neighbours,
    and the node, to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links, any orderable type -> (node, label): the least node of
    its component, for every node that has a link to another node."""
    edges = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct())
    state = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state:
            labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
            labels._cut_path = edges._cut_path  # for discard_cut
            return labels
        state, before = mark, edges
        edges = cut_lineage(_small_star(_large_star(before)))
        discard_cut(before)
