"""Global row numbers and surrogate keys without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martkit.session import settle

_SLOT_BITS = 33  # low bits of monotonically_increasing_id hold the row's place in its partition


def global_ordinal(
    df: DataFrame, order_by: Sequence[str], name: str = "ordinal", start: int = 1
) -> DataFrame:
    """Number all rows by ``order_by``, which must end in a unique column.

    Rows are range-partitioned and sorted, each row notes its place in its
    partition, and one size per partition (the only data that meets in one
    task) yields the offsets. The placed rows are checkpointed so that both
    uses see the same split even when an executor is lost.
    """
    placed = settle(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("_slot", _SLOT_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    place = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(name, (F.col("_before") + place + F.lit(start)).cast("bigint"))
        .drop("_part", "_slot", "_before")
    )


def assign_ids(
    new_rows: DataFrame, current: DataFrame | None, sk: str, order_by: Sequence[str]
) -> DataFrame:
    """Surrogate keys for ``new_rows``, continuing above those of ``current``."""
    numbered = global_ordinal(new_rows, order_by, sk)
    if current is not None:
        top = current.agg(F.coalesce(F.max(sk), F.lit(0)).alias("top")).scalar()
        numbered = numbered.withColumn(sk, (F.col(sk) + top).cast("bigint"))
    return numbered.select(sk, *[c for c in numbered.columns if c != sk])
