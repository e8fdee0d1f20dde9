"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.session import settle


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other; keys come from the left.

    Still a hash or merge join: Spark rewrites ``<=>`` into equality on the
    coalesced key and its null flag.
    """
    marked = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    on: Column = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    )
    joined = left.join(marked, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(
        *[f"_right_{k}" for k in keys]
    )


HASH = "_hash"  # hash of the keys that a side is dealt by


def deal(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """``df`` with a hash of ``keys`` in ``_hash``, dealt by it into ``parts`` partitions."""
    return df.withColumn(HASH, F.xxhash64(*keys)).repartition(parts, HASH)


def join_dealt(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, parts: int) -> DataFrame:
    """``join_same`` of large sides, in a given number of partitions (``spread_parts``; 0: as Spark likes).

    Both sides are dealt by one hash of their keys, unless ``deal`` did so
    before. Rows of equal hash are compared by the keys themselves, null keys
    matching. Keys whose types differ have no common hash and meet in ``join_same``.
    """
    if not parts or any(left.schema[k].dataType != right.schema[k].dataType for k in keys):
        return join_same(left.drop(HASH), right.drop(HASH), keys, how)
    left, right = (df if HASH in df.columns else deal(df, keys, parts) for df in (left, right))
    # both lie as a merge join needs them; a broadcast would pass a large side through the driver
    marked = right.hint("merge").select(
        *[F.col(k).alias(f"_right_{k}") for k in [HASH, *keys]],
        *[c for c in right.columns if c not in (HASH, *keys)],
    )
    # not as <=>, which would make each key a key of the join and of its shuffle
    same = reduce(
        lambda a, b: a & b,
        [
            F.coalesce(F.col(k) == F.col(f"_right_{k}"), F.col(k).isNull() & F.col(f"_right_{k}").isNull())
            for k in keys
        ],
        F.col(HASH) == F.col(f"_right_{HASH}"),
    )
    return left.join(marked, same, how).drop(HASH, *[f"_right_{k}" for k in [HASH, *keys]])


def split_hot_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    condition: Column,
    left_id: str,
    right_id: str,
    block_rows: int = 4000,
    max_broadcast_keys: int = 100_000,
) -> DataFrame:
    """Inner equi-join plus pair ``condition`` whose work per key is bounded.

    A counting pass finds the keys with more than ``block_rows`` rows on a
    side. Without any, this is the plain join. Otherwise each hot key is cut
    into blocks by a hash of the side's id, and every block of one side meets
    every block of the other: a (key, block, block) unit compares at most about
    ``block_rows`` squared pairs, and only pairs that satisfy ``condition``
    leave the join. The split is exact: no row is dropped or capped.

    Column names of the two sides other than ``on`` must differ.
    """
    marked = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in on], *[c for c in right.columns if c not in on]
    )
    equal = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_r_{k}") for k in on])
    dropped = [f"_r_{k}" for k in on]

    hot = settle(_hot_keys(left, right, on, block_rows))
    hot_count = hot.limit(max_broadcast_keys + 1).count()
    if hot_count == 0:
        return left.join(marked, equal & condition, "inner").drop(*dropped)
    if hot_count <= max_broadcast_keys:
        hot = F.broadcast(hot)

    def blocked(side, keys, own, other, own_count, other_count, id_col):
        sized = side.join(
            hot.select(*[F.col(k).alias(s) for k, s in zip(on, keys)], "_lb", "_rb"), keys, "left"
        )
        own_block = F.pmod(F.xxhash64(F.col(id_col)), F.coalesce(F.col(own_count), F.lit(1)))
        others = F.sequence(F.lit(0), F.coalesce(F.col(other_count), F.lit(1)) - 1)
        return (
            sized.withColumn(own, own_block.cast("int"))
            .withColumn(other, F.explode(others))
            .drop("_lb", "_rb")
        )

    l_rows = blocked(left, list(on), "_l1", "_l2", "_lb", "_rb", left_id)
    r_rows = blocked(marked, dropped, "_r2", "_r1", "_rb", "_lb", right_id)
    same_unit = (F.col("_l1") == F.col("_r1")) & (F.col("_l2") == F.col("_r2"))
    return l_rows.join(r_rows, equal & same_unit & condition, "inner").drop(
        *dropped, "_l1", "_l2", "_r1", "_r2"
    )


def _hot_keys(left: DataFrame, right: DataFrame, on: Sequence[str], block_rows: int) -> DataFrame:
    """Keys with more than ``block_rows`` rows on a side, and their block counts."""
    return (
        left.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy(*on)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .where((F.col("_l") > block_rows) | (F.col("_r") > block_rows))
        .where((F.col("_l") > 0) & (F.col("_r") > 0))
        .select(
            *on,
            F.ceil(F.col("_l") / block_rows).cast("int").alias("_lb"),
            F.ceil(F.col("_r") / block_rows).cast("int").alias("_rb"),
        )
    )
