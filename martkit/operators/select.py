"""Row selection: slices, validity, latest and best rows, pages, conditional counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkit.operators.joins import join_same


def slice_by_date(df: DataFrame, ts_col: str, day: date) -> DataFrame:
    """Rows of one business day of the session zone, as a half-open range the scan can push down.

    The bounds are text cast by Spark: a Python datetime would be read in the
    zone of the driver process.
    """
    kind = df.schema[ts_col].dataType
    start = date(day.year, day.month, day.day)
    low = F.lit(start.isoformat()).cast(kind)
    high = F.lit((start + timedelta(days=1)).isoformat()).cast(kind)
    return df.where((F.col(ts_col) >= low) & (F.col(ts_col) < high))


def active_at(df: DataFrame, start: str, end: str, as_of: Column) -> DataFrame:
    """Rows valid at ``as_of``: the start belongs to the interval, the end does not."""
    return df.where((F.col(start) <= as_of) & (as_of < F.col(end)))


def _first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key.

    The filter sits directly on the row number, so Spark keeps one row per key
    and map task before the shuffle: a hot key never travels whole, and columns
    nobody reads later are still pruned.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).where(F.col("_row") == 1).drop("_row")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order_by``; end it with a unique column."""
    return _first_row(df, keys, [F.col(c).desc() for c in order_by])


def best_per_group(
    df: DataFrame, by: Sequence[str], order_by: Sequence[Column], largest: bool = True
) -> DataFrame:
    """Arg-max (or arg-min) row per group over ``order_by`` expressions."""
    return _first_row(df, by, [c.desc() if largest else c.asc() for c in order_by])


def top_k_per_group(df: DataFrame, by: Sequence[str], order_by: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per group with their ``row_no``.

    The rank filter sits directly on the window, so Spark cuts each group to
    ``k`` rows per map task before the shuffle.
    """
    window = Window.partitionBy(*by).orderBy(*order_by)
    return df.withColumn("row_no", F.row_number().over(window)).where(F.col("row_no") <= k)


def ranked_first(df: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    """Rows whose ``measure`` is the greatest of their group, ties kept."""
    if not by:
        return df.where(F.col(measure) == df.agg(F.max(measure)).scalar())
    window = Window.partitionBy(*by).orderBy(F.col(measure).desc())
    return (
        df.withColumn("_rank", F.dense_rank().over(window)).where(F.col("_rank") == 1).drop("_rank")
    )


def flag_first(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    row_id: str,
    where: Column | None = None,
    name: str = "is_first",
) -> DataFrame:
    """1 on the earliest row of each key (among rows meeting ``where``), else 0.

    The earliest row is found by a map-side combined aggregate and joined back
    on the unique ``row_id``, so hot keys do not gather in one task.
    """
    rows = df if where is None else df.where(where)
    firsts = (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min_by(F.col(row_id), F.struct(*order_by)).alias("_first_id"))
        .select("_first_id")
    )
    return (
        df.join(firsts, F.col(row_id) == F.col("_first_id"), "left")
        .withColumn(name, F.col("_first_id").isNotNull().cast("int"))
        .drop("_first_id")
    )


def signed_amount(
    df: DataFrame, amount: str, status: str, refund_values: Iterable[str]
) -> DataFrame:
    """Amounts of refunded rows turned negative; all others as they are."""
    refunded = F.col(status).isin(*refund_values)
    return df.withColumn(amount, F.when(refunded, -F.col(amount)).otherwise(F.col(amount)))


def count_by_value(
    df: DataFrame, group: Sequence[str], col: str, values: Mapping[str, str]
) -> DataFrame:
    """One count column per listed value; ``values`` maps output name to value."""
    return df.groupBy(*group).agg(
        *[F.count_if(F.col(col) == value).alias(name) for name, value in values.items()]
    )


def ordered_list(order: Column, value: Column) -> Column:
    """Aggregate: values of a group in the given order.

    The list is one cell of the result, so reduce the group first (for
    instance to islands) where it can be long.
    """
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.transform(pairs, lambda p: p["v"])


def keyset_page(df: DataFrame, id_col: str, after: int, limit: int) -> DataFrame:
    """The next ``limit`` rows above an id, in id order."""
    return df.where(F.col(id_col) > F.lit(after)).orderBy(id_col).limit(limit)


def oldest_n(df: DataFrame, keep: DataFrame, key: str, order_by: Sequence[Column], n: int) -> DataFrame:
    """Rows of ``df`` whose key is among the first ``n`` keys of ``keep``."""
    return join_same(df, keep.orderBy(*order_by).limit(n).select(key), [key], "left_semi")
