"""Database tables over Spark's JDBC source. Hosts and secrets come from the caller."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, options: Mapping[str, str], table: str) -> DataFrame:
    """Whole table. Pass ``partitionColumn`` and its bounds in ``options`` for a parallel read."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def day_predicates(ts_col: str, first: date, last: date) -> list[str]:
    """One half-open predicate per day of [first, last]."""
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    return [
        f"{ts_col} >= DATE '{d}' AND {ts_col} < DATE '{d + timedelta(days=1)}'" for d in days
    ]


def read_days(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    ts_col: str,
    first: date,
    last: date,
) -> DataFrame:
    """Date-sliced read, one task per day, the slice evaluated by the database."""
    return spark.read.jdbc(
        url, table, predicates=day_predicates(ts_col, first, last), properties=dict(properties)
    )


def append_sink(options: Mapping[str, str], table: str) -> Callable[..., None]:
    """Writer that appends a frame to a database table, at least once per batch."""

    def write(df: DataFrame, batch_id: int | None = None) -> None:
        df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()

    return write
