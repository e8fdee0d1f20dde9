"""Order-log staging, daily sales fact and weekly customer retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.dates import week_start
from martkit.operators.quality import ensure_columns
from martkit.operators.select import latest_per_key, signed_amount, slice_by_date

# The state assumed for files without a status, the refund state.
DEFAULT_STATUS = "shipped"
REFUNDED = "refunded"


def stage_order_log(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One row per ``uniq_id``, a status on every row, refunds negative."""
    rows = ensure_columns(raw, {"status": F.lit(DEFAULT_STATUS)}).drop("id")
    order = order_by or [c for c in rows.columns if c != "uniq_id"]
    unique = latest_per_key(rows, ["uniq_id"], order)
    return signed_amount(unique, "payment_amount", "status", [REFUNDED])


def sales_fact(staged: DataFrame, calendar: DataFrame, day: date | None = None) -> DataFrame:
    """Sales of one business day, or of all days for a first load."""
    rows = staged if day is None else slice_by_date(staged, "date_time", day)
    dates = calendar.select("date_id", "date_actual")
    return rows.join(dates, F.to_date("date_time") == F.col("date_actual"), "left").select(
        "date_id",
        "date_actual",
        "item_id",
        "customer_id",
        "city_id",
        "quantity",
        "payment_amount",
        "status",
    )


def customer_retention(sales: DataFrame) -> DataFrame:
    """New, returning and refunded customers and their revenue per (week, item)."""
    weekly = sales.groupBy(
        week_start(F.col("date_actual")).alias("week_start"), "item_id", "customer_id"
    ).agg(
        F.count("*").alias("orders_count"),
        F.count_if(F.col("status") == REFUNDED).alias("refund_count"),
        F.sum("payment_amount").alias("revenue"),
    )
    kept = F.col("refund_count") == 0
    new = kept & (F.col("orders_count") == 1)
    returning = kept & (F.col("orders_count") > 1)
    nothing = F.lit(0).cast("decimal(18,2)")
    # one row per customer on this level, so counting rows counts customers
    return (
        weekly.groupBy("week_start", "item_id")
        .agg(
            F.count_if(new).alias("new_customers_count"),
            F.count_if(returning).alias("returning_customers_count"),
            F.count_if(~kept).alias("refunded_customer_count"),
            F.sum(F.when(new, F.col("revenue")).otherwise(nothing)).alias("new_customers_revenue"),
            F.sum(F.when(returning, F.col("revenue")).otherwise(nothing)).alias(
                "returning_customers_revenue"
            ),
            F.sum("refund_count").alias("customers_refunded"),
        )
        .withColumn("period_name", F.lit("weekly"))
        .withColumn("period_id", F.weekofyear("week_start"))
    )
