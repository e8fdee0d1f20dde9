"""Test tables: Parquet, money columns as decimal(12,2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MONEY = {
    "customer": ("c_acctbal",),
    "supplier": ("s_acctbal",),
    "part": ("p_retailprice",),
    "orders": ("o_totalprice",),
    "lineitem": ("l_extendedprice", "l_discount", "l_tax"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    money = _MONEY.get(name, ())
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in money}) if money else df
