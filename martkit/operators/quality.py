"""Schema drift defaults, row rules, key checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ensure_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add columns an older file lacks; existing columns are left alone."""
    missing = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def one_of(col: str, values: Iterable[str]) -> Column:
    """Rule: the value belongs to an enumeration."""
    return F.col(col).isin(*values)


def text_length(col: str, limit: int) -> Column:
    """Rule: text fits a declared length."""
    return F.char_length(F.col(col)) <= limit


def tag_failed_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``failed_rules``; as in a CHECK constraint, an unknown outcome passes."""
    marks = [
        F.when(F.coalesce(rule, F.lit(True)), F.lit(None)).otherwise(F.lit(name))
        for name, rule in rules.items()
    ]
    return df.withColumn("failed_rules", F.array_compact(F.array(*marks)))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet every rule, rejected rows with the rules they break)."""
    tagged = tag_failed_rules(df, rules)
    good = tagged.where(F.size("failed_rules") == 0).drop("failed_rules")
    return good, tagged.where(F.size("failed_rules") > 0)


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values carried by more than one row, with their ``row_count``."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def find_orphans(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]
) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    left = child.dropna(subset=list(child_keys))
    right = parent.select(
        *[F.col(p).alias(f"_parent_{i}") for i, p in enumerate(parent_keys)]
    ).distinct()
    on = [F.col(c) == F.col(f"_parent_{i}") for i, c in enumerate(child_keys)]
    return left.join(right, on, "left_anti")


def null_share(df: DataFrame, col: str, missing_values: Iterable[str] = ()) -> DataFrame:
    """Percentage of rows where the value is null or one of ``missing_values``."""
    missing = F.col(col).isNull()
    words = list(missing_values)
    if words:
        missing = missing | F.col(col).isin(*words)
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(missing).alias("missing_rows"),
    ).withColumn(
        "missing_percent",
        F.try_divide(F.lit(100.0) * F.col("missing_rows"), F.col("total_rows").cast("double")),
    )
