"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.stored import stored


def _least(edges: DataFrame) -> DataFrame:
    """For every node its least neighbour or itself; one row per node."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours, linked to the least of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.filter("b > a").join(_least(both), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    if not edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty()


def with_links(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found (node, component)`` after more ``links (a, b)``: components of components."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    fresh = ends.join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    known = stored(found.unionByName(fresh), "known")
    of = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    higher = components(between).select(F.col("node").alias("component"), F.col("component").alias("higher"))
    return known.join(higher, "component", "left").select("node", F.coalesce("higher", "component").alias("component"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``: the least node it can reach.

    Each round's edges are written to the shared folder. Edges point to smaller nodes and have
    settled when they are stars: no node points to two, and none is pointed to that itself points
    on. A node's stars are joins of its own edges, so a node with a third of all edges is split
    by the join."""
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    for _ in range(rounds):
        if _are_stars(current):
            break
        current = stored(_small_star(stored(_large_star(current), "large")), "small")
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
