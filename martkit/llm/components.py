"""Connected components by star contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import release, stored


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """Stored, so that Spark can split the join back at a hub."""
    return stored(pairs.groupBy("u").agg(F.min("v").alias("least")), "least")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable over ``edges`` (a, b).

    Alternates two steps until nothing changes: every node hands its greater
    neighbours to its least neighbour, then its smaller ones. Both preserve
    components and end with one star per component. Only edges move; the
    neighbours of a node never meet in one row, so a hub's edges can be split
    over tasks. Nodes without an edge do not appear. Null ends are no edge.
    """
    now = stored(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    mark = None
    for _ in range(max_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        # Greater neighbours move to the least of the closed neighbourhood.
        near = _least_neighbour(both)
        large = (
            both.join(near, "u")
            .where("v > u")
            .select(F.least("u", "least").alias("a"), F.col("v").alias("b"))
            .where("a <> b")
            .distinct()
        )
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        # Smaller neighbours, and the node itself, move to the least neighbour.
        below = _least_neighbour(down)
        small = down.join(below, "u")
        moved = (
            small.select(F.col("least").alias("a"), F.col("v").alias("b"))
            .unionAll(small.select(F.col("least").alias("a"), F.col("u").alias("b")))
            .where("a <> b")
            .distinct()
        )
        after = stored(moved, "edges")
        release(now, near, below)
        now = after
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    heads = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(heads)
