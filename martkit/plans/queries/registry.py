"""Registry of queries: a Spark function and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.session import scratch_path
from martkit.sources.files import refresh_table
from martkit.sources.tables import table


class Tables:
    """Table lookup of one query run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a stored table, where a job reads its input more than once."""
        return refresh_table(df, self.scratch(name))


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, run, sql)
        return run

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: decimals as double, timestamps as text."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            col = F.array_join(col, "|")
        out.append(col.alias(f.name))
    return df.select(*out)
