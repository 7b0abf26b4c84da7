"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import drop, materialise


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Link a node's neighbours to the smallest of them and itself; large: those above it, small: those below it.

    The least neighbour is a combined sum, joined back to the edges: a hub with very many links stays rows that
    adaptive execution can split, never one group.
    """
    around = both_ways(edges) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = around.join(least, "a")
    if large:
        linked = linked.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return linked.filter(F.col("a") != F.col("b")).distinct()
    to_least = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    itself = least.select("a", F.col("m").alias("b"))
    return to_least.unionByName(itself).filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in an edge; component is the smallest node reachable.

    Each round is written to the shared folder, which cuts the lineage and gives the figures of the stopping test: the
    edges no longer change when a round leaves their number and their combined hash as they were. Only the last round's
    table stays.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = materialise(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "links")
    was = state(now)
    for _ in range(most_rounds):
        before, now = now, materialise(star(star(now, True), False), "links")
        found = state(now)
        drop(before)
        if found == was:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        was = found
    raise RuntimeError(f"components still change after {most_rounds} rounds")
