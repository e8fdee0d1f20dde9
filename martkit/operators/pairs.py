"""Pairs of entities: shared groups and known contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.points import pairs_within_km
from martkit.session import settle


def co_occurring_pairs(
    members: DataFrame,
    points: DataFrame,
    id_col: str,
    group_col: str,
    km: float = 1.0,
    block_rows: int = 4000,
) -> DataFrame:
    """Distinct pairs (id_left < id_right) that share a group and lie within ``km``.

    Group and grid cell form one join key, so a popular group never meets
    itself as a whole: only neighbours inside it are compared.
    """
    # read four times below (counting and joining, on both sides), so written once
    located = settle(
        members.select(id_col, group_col).distinct().join(points.select(id_col, "lat", "lon"), id_col)
    )
    return (
        pairs_within_km(located, id_col, km, share=group_col, block_rows=block_rows)
        .select("id_left", "id_right")
        .distinct()
    )


def exclude_known_pairs(
    pairs: DataFrame, edges: DataFrame, from_col: str, to_col: str
) -> DataFrame:
    """Pairs without an edge in either direction.

    Edges are turned into the same low-high form as the pairs, which keeps the
    anti-join an equi-join.
    """
    known = edges.select(
        F.least(from_col, to_col).alias("id_left"), F.greatest(from_col, to_col).alias("id_right")
    ).distinct()
    return pairs.join(known, ["id_left", "id_right"], "left_anti")
