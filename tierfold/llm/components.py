"""Connected components of a distributed list of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    links = _both_ways(edges)
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return (
        links.filter("b > a")
        .join(least.select("a", F.least("a", "m").alias("m")), "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.union(own).filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 30)), F.bit_xor(F.xxhash64("a", "b"))
        ).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node of ``edges`` (a, b).

    Alternates large-star and small-star rounds until nothing changes, each written to the
    shared folder, so no round is repeated when an executor is lost. Nodes of one component end
    as a star around the smallest; nodes are never gathered in one place. Order in which
    nodes compare is that of their type. Edges with a null or equal ends count for nothing.
    """
    now = written(
        edges.select("a", "b").filter("a <> b").distinct(), "component-edges"
    )  # nulls fail the filter
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "component-edges")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
