"""From conformed order rows to dimensions, fact and customer report."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.load import merge_dim, resolve_keys
from martkit.plans.marts.customer_report import customer_report
from martkit.session import scratch_path, unbroadcast
from martkit.sources.files import refresh_table

# dimension -> (surrogate key, natural key, other columns)
DIMS = {
    "craftsmen": (
        "craftsman_id",
        ["craftsman_name", "craftsman_email"],
        ["craftsman_address", "craftsman_birthday"],
    ),
    "products": (
        "product_id",
        ["product_name", "product_description", "product_price"],
        ["product_type"],
    ),
    "customers": (
        "customer_id",
        ["customer_name", "customer_email"],
        ["customer_address", "customer_birthday"],
    ),
}
FACT_KEY = ["product_id", "craftsman_id", "customer_id", "order_created_date"]
FACT_COLS = ["order_completion_date", "order_status"]


def empty_tables(staged: DataFrame) -> dict[str, DataFrame]:
    """Dimensions and fact before the first load."""
    stamp = F.lit(None).cast("timestamp").alias("load_dttm")
    none = staged.limit(0)
    out = {
        name: none.select(F.lit(0).cast("bigint").alias(sk), *natural, *cols, stamp)
        for name, (sk, natural, cols) in DIMS.items()
    }
    ids = [F.lit(0).cast("bigint").alias(k) for k in FACT_KEY[:3]]
    out["orders"] = none.select(*ids, "order_created_date", *FACT_COLS, stamp)
    return out


def load_warehouse(
    current: Mapping[str, DataFrame], staged: DataFrame, load_ts: datetime
) -> dict[str, DataFrame]:
    """Merge conformed rows into the dimensions, then into the fact.

    The merged dimensions are stored, as the fact reads them again.
    """
    out = {}
    for name, (sk, natural, cols) in DIMS.items():
        merged = merge_dim(current[name], staged, natural, cols, load_ts, sk)
        out[name] = refresh_table(merged, scratch_path(staged.sparkSession, f"merged-{name}"))
    keyed = resolve_keys(
        staged.drop(*[sk for sk, _, _ in DIMS.values()]),
        [(out[name], {c: c for c in natural}, sk) for name, (sk, natural, _) in DIMS.items()],
        "inner",
    )
    out["orders"] = merge_dim(current["orders"], keyed, FACT_KEY, FACT_COLS, load_ts)
    return out


def report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Customer report over the loaded tables."""
    prices = unbroadcast(tables["products"].select("product_id", "product_price"))
    fact = tables["orders"].join(prices, "product_id")
    return customer_report(fact, tables["customers"], tables["products"])
