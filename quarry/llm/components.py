"""Distributed connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import reliable_checkpoint


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """``(u, m)``: the least of u and its neighbours (combined map-side)."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as ``(u, v)`` edges.

    Returns ``(node, root)`` for every node of an edge that joins two
    different nodes; ``root`` is the least node of the component.  Nulls,
    loops and repeated edges are ignored; no edges give no rows.  Each round
    rewires edges to lesser nodes (large star, then small star) and is
    written to the shared checkpoint folder; the rounds end when no edge
    changes.  A hub's edges are combined map-side for its least neighbour,
    and the join that rewires them is one that AQE can split.
    """
    edges = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
             .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).distinct())
    edges = reliable_checkpoint(edges)
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.where(F.col("v") > F.col("u")).join(_least_neighbour(both), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        least = _least_neighbour(large)
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        edges = reliable_checkpoint(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
