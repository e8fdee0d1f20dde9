"""Monthly courier settlement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.load import upsert

# Fixed values: (rating below, share of the order sum, minimum per order), the
# rates of the last tier, the processing fee and the courier's part of tips.
TIERS = [(4.0, "0.05", 100), (4.5, "0.07", 150), (4.9, "0.08", 175)]
TOP_TIER = ("0.10", 200)
PROCESSING_FEE = "0.25"
TIPS_SHARE = "0.95"

# Fixed value: the delivery document.
DELIVERY = """
    delivery_id string, courier_id bigint, order_id bigint, address string,
    delivery_ts string, rate int, tip_sum decimal(14,2)
"""


def courier_ledger(
    orders: DataFrame, deliveries: DataFrame, product_sales: DataFrame, couriers: DataFrame
) -> DataFrame:
    """One row per (courier, year, month).

    Product lines are summed to the order before ratings and tips join, so
    neither is multiplied by the number of lines; names join the finished
    groups.
    """
    totals = product_sales.groupBy("order_id").agg(F.sum("total_sum").alias("order_total"))
    monthly = (
        orders.join(totals, "order_id")
        .join(deliveries.select("order_id", "courier_id", "rate", "tip_sum"), "order_id")
        .groupBy(
            "courier_id",
            F.year("order_ts").alias("settlement_year"),
            F.month("order_ts").alias("settlement_month"),
        )
        .agg(
            F.count("*").alias("orders_count"),
            F.sum("order_total").alias("orders_total_sum"),
            F.avg(F.col("rate").cast("double")).alias("rate_avg"),
            F.sum("tip_sum").alias("courier_tips_sum"),
        )
    )

    def reward(share: str, minimum: int):
        return F.greatest(
            F.col("orders_total_sum") * F.lit(share).cast("decimal(3,2)"),
            (F.col("orders_count") * minimum).cast("decimal(24,4)"),
        )

    by_tier = None
    for below, share, minimum in TIERS:
        hit = F.col("rate_avg") < below
        by_tier = (F if by_tier is None else by_tier).when(hit, reward(share, minimum))
    return (
        monthly.withColumn(
            "order_processing_fee",
            F.col("orders_total_sum") * F.lit(PROCESSING_FEE).cast("decimal(3,2)"),
        )
        .withColumn("courier_order_sum", by_tier.otherwise(reward(*TOP_TIER)))
        .withColumn(
            "courier_reward_sum",
            F.col("courier_order_sum")
            + F.col("courier_tips_sum") * F.lit(TIPS_SHARE).cast("decimal(3,2)"),
        )
        .join(couriers.select("courier_id", "courier_name"), "courier_id")
        .select(
            "courier_id",
            "courier_name",
            "settlement_year",
            "settlement_month",
            "orders_count",
            "orders_total_sum",
            "rate_avg",
            "order_processing_fee",
            "courier_order_sum",
            "courier_tips_sum",
            "courier_reward_sum",
        )
    )


LEDGER_KEY = ["courier_id", "settlement_year", "settlement_month"]


def shred_deliveries(documents: DataFrame) -> DataFrame:
    """Typed deliveries from landed documents (object_id, object_value)."""
    return documents.select(F.from_json("object_value", DELIVERY).alias("d")).select("d.*")


def refresh_ledger(current: DataFrame, computed: DataFrame) -> DataFrame:
    """Ledger with the computed months replaced or added."""
    return upsert(current, computed, LEDGER_KEY)
