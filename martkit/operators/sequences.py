"""Ordered rows per key: previous value, change points, islands, ordinals, calendar.

A plain window over a key puts the key's whole history into one task. These
operators cut each history into chunks of time first, work inside
(key, chunk), and carry only one summary row per chunk across chunk borders.
Chunks are days by default; pass a finer ``chunk`` where a key holds more rows
per day than a task should.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martkit.operators.joins import join_same
from martkit.operators.select import best_per_group


def _with_chunk(df: DataFrame, order_by: Sequence[str], chunk: Column | None) -> DataFrame:
    return df.withColumn("_chunk", F.to_date(F.col(order_by[0])) if chunk is None else chunk)


def previous_value(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    value: str,
    name: str = "previous",
    chunk: Column | None = None,
) -> DataFrame:
    """Add the value of the preceding row of the same key, and ``_is_first``."""
    rows = _with_chunk(df, order_by, chunk)
    inside = Window.partitionBy(*key, "_chunk").orderBy(*order_by)
    across = Window.partitionBy(*key).orderBy("_chunk")
    borders = (
        rows.groupBy(*key, "_chunk")
        .agg(F.max_by(F.col(value), F.struct(*order_by)).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(across))
        .withColumn("_opens", F.row_number().over(across) == 1)
        .drop("_last")
    )
    numbered = rows.withColumn("_no", F.row_number().over(inside)).withColumn(
        "_inner", F.lag(value).over(inside)
    )
    at_border = F.col("_no") == 1
    return (
        join_same(numbered, borders, [*key, "_chunk"], "inner")
        .withColumn(name, F.when(at_border, F.col("_carried")).otherwise(F.col("_inner")))
        .withColumn("_is_first", at_border & F.col("_opens"))
        .drop("_chunk", "_no", "_inner", "_carried", "_opens")
    )


def change_points(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    value: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Rows whose value differs from the preceding row of their key, with ``previous``."""
    rows = previous_value(df, key, order_by, value, "previous", chunk)
    changed = ~F.col(value).eqNullSafe(F.col("previous")) & ~F.col("_is_first")
    return rows.where(changed).drop("_is_first")


def ordinal_within(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    name: str = "ordinal",
    chunk: Column | None = None,
) -> DataFrame:
    """Position of each row within its key, from 1."""
    rows = _with_chunk(df, order_by, chunk)
    inside = Window.partitionBy(*key, "_chunk").orderBy(*order_by)
    before = (
        Window.partitionBy(*key)
        .orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*key, "_chunk")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    numbered = rows.withColumn("_no", F.row_number().over(inside))
    return (
        join_same(numbered, offsets, [*key, "_chunk"], "inner")
        .withColumn(name, (F.col("_before") + F.col("_no")).cast("bigint"))
        .drop("_chunk", "_no", "_before")
    )


def islands(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    value: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Runs of equal consecutive values: key, value, island_no, started, ended, row_count.

    ``started`` and ``ended`` are the first and last ``order_by[0]`` of a run;
    ``island_no`` counts from 1 within the key.
    """
    at = order_by[0]
    rows = _with_chunk(
        df.select(*key, *[c for c in order_by if c not in key], *([value] if value not in order_by else [])),
        order_by,
        chunk,
    )
    inside = Window.partitionBy(*key, "_chunk").orderBy(*order_by)
    starts = ~F.col(value).eqNullSafe(F.lag(value).over(inside)) & (F.row_number().over(inside) > 1)
    runs = (
        rows.withColumn("_starts", starts.cast("int"))
        .withColumn("_run", F.sum("_starts").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "_chunk", "_run")
        .agg(
            F.first(value).alias(value),
            F.min(at).alias("started"),
            F.max(at).alias("ended"),
            F.count("*").alias("row_count"),
        )
    )
    across = Window.partitionBy(*key).orderBy("_chunk")
    opened = F.row_number().over(across) == 1
    offsets = (
        runs.groupBy(*key, "_chunk")
        .agg(
            (F.max("_run") + 1).alias("_runs"),
            F.min_by(value, "_run").alias("_first"),
            F.max_by(value, "_run").alias("_last"),
        )
        .withColumn(
            "_glued",
            (F.col("_first").eqNullSafe(F.lag("_last").over(across)) & ~opened).cast("int"),
        )
        .withColumn(
            "_offset",
            F.sum(F.col("_runs") - F.col("_glued")).over(
                across.rowsBetween(Window.unboundedPreceding, 0)
            )
            - F.col("_runs"),
        )
        .select(*key, "_chunk", "_offset")
    )
    return (
        join_same(runs, offsets, [*key, "_chunk"], "inner")
        .withColumn("island_no", (F.col("_offset") + F.col("_run") + 1).cast("bigint"))
        .groupBy(*key, "island_no")
        .agg(
            F.first(value).alias(value),
            F.min("started").alias("started"),
            F.max("ended").alias("ended"),
            F.sum("row_count").alias("row_count"),
        )
    )


def longest_island(runs: DataFrame, key: Sequence[str], min_days: int = 27) -> DataFrame:
    """Longest run per key lasting at least ``min_days``; the later start wins a tie."""
    stays = runs.withColumn("stay_days", F.datediff("ended", "started")).where(
        F.col("stay_days") >= min_days
    )
    return best_per_group(
        stays, key, [F.col("stay_days"), F.col("started"), F.col("island_no")]
    )


def calendar_dim(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day of [start, end]: date_id, date_actual and its parts."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_actual")
    )
    return days.select(
        F.date_format("date_actual", "yyyyMMdd").cast("int").alias("date_id"),
        "date_actual",
        F.year("date_actual").alias("year_actual"),
        F.month("date_actual").alias("month_actual"),
        F.weekofyear("date_actual").alias("week_of_year"),
        F.to_date(F.date_trunc("week", "date_actual")).alias("first_day_of_week"),
        F.dayofweek("date_actual").isin(1, 7).alias("weekend"),
    )
