"""Exact medians of groups of any size, by counting ranks over ranges of values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martkit.session import settle


def exact_median(df: DataFrame, by: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """(*by, name): the mean of the two middle values of every group, exactly.

    Equal values of a group are counted before anything else. The counts are laid
    out in ranges of (group, value); a sum per range tells which range holds the
    middle ranks, and only rows of those ranges are ranked. A group of all rows
    spreads over as many tasks as there are ranges. Null values do not count, a
    group of nulls only has no row; null group keys form a group.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    # Stored, so both passes see the same ranges.
    placed = settle(counted.repartitionByRange(*by, value).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy(*by)
    upto = inside.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*by, "_range").agg(F.sum("_n").alias("_rows"))  # one row per group and range
    sums = sums.select(
        *by, "_range", "_rows", F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_before"), F.sum("_rows").over(inside).alias("_all")
    )
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    middle = sums.where((F.col("_before") < high) & (F.col("_before") + F.col("_rows") >= low))
    middle = middle.select(*[F.col(c).alias(f"_of_{c}") for c in [*by, "_range"]], "_before", low.alias("_low"), high.alias("_high"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by], F.col("_range") == F.col("_of__range"))
    order = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.join(middle, same).withColumn("_upto", F.col("_before") + F.sum("_n").over(order))
    holds = lambda rank: (F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_n") < F.col(rank))
    at = lambda rank: F.max(F.when(holds(rank), F.col(value)))
    return ranked.groupBy(*by).agg(((at("_low") + at("_high")) / 2).alias(name))
