"""Connected components of links between numbers, by alternating star operations on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .store import discard, written


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for each node of the links (a, b); nulls and self-links count as none.

    Each round points every node's larger neighbours at its least neighbour (large star), then its smaller ones (small
    star); after O(log n) rounds what is left are stars.  Least neighbours are an aggregation (combined before the
    shuffle) on a table of its own, so the join that follows has a plain exchange on both sides and a node with very many
    links is split by adaptive execution.
    """
    edges = written(links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "links-least")
        # large star: (v, m(u)) for neighbours v > u
        large = written(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "links-large")
        # small star: edges point from the larger to the smaller end; all smaller neighbours and u itself point at the least
        down = written(large.groupBy("u").agg(F.min("v").alias("m")), "links-down")
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        new = written(small, "links")
        discard(edges, least, large, down)
        # stars that don't change: each node points at one node that points at none
        roots = new.select(F.col("v").alias("u")).distinct()
        if not new.join(roots, "u", "left_semi").limit(1).count():
            break
        edges = new
    return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
