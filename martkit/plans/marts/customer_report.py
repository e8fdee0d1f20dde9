"""Customer report per (customer, month), full and incremental."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.dates import month_key
from martkit.operators.load import changed_keys
from martkit.operators.select import best_per_group
from martkit.session import spread, unbroadcast

# The platform's part of the money and the counted order states.
PLATFORM_SHARE = "0.1"
STATUSES = {
    "count_order_created": "created",
    "count_order_in_progress": "in progress",
    "count_order_delivery": "delivery",
    "count_order_done": "done",
}


def _most_frequent(counts: DataFrame, value: str, name: str) -> DataFrame:
    """Most frequent value per customer; the smaller value wins a tie."""
    best = best_per_group(counts, ["customer_id"], [-F.col("n"), F.col(value)], largest=False)
    return best.select("customer_id", F.col(value).alias(name))


def customer_report(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Months of every customer in ``fact``; tops are over the customer's whole history.

    Rows of a large stored fact are dealt by customer once for all aggregates,
    windows and joins by customer, in partitions whose number grows with it.
    """
    by_customer = spread(fact, "customer_id")
    monthly = by_customer.groupBy(
        "customer_id", month_key(F.col("order_created_date")).alias("report_period")
    ).agg(
        F.sum("product_price").alias("customer_money"),
        F.count("*").alias("count_order"),
        F.median(F.datediff("order_completion_date", "order_created_date")).alias(
            "median_time_order_completed"
        ),
        *[F.count_if(F.col("order_status") == v).alias(n) for n, v in STATUSES.items()],
        F.count_if(F.col("order_status") != "done").alias("count_order_not_done"),
    )
    by_product = spread(fact.select("customer_id", "product_id"), "product_id")
    per_product = by_product.groupBy("customer_id", "product_id").agg(F.count("*").alias("c"))
    typed = per_product.join(unbroadcast(products.select("product_id", "product_type")), "product_id")
    categories = (
        spread(typed, "customer_id", like=fact)
        .groupBy("customer_id", "product_type")
        .agg(F.sum("c").alias("n"))
    )
    craftsmen = by_customer.groupBy("customer_id", "craftsman_id").agg(F.count("*").alias("n"))
    people = customers.select(
        "customer_id", "customer_name", "customer_address", "customer_birthday", "customer_email"
    )
    return (
        monthly.join(unbroadcast(people), "customer_id")
        .join(_most_frequent(categories, "product_type", "top_product_category"), "customer_id", "left")
        .join(_most_frequent(craftsmen, "craftsman_id", "top_craftsman_id"), "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            "customer_address",
            "customer_birthday",
            "customer_email",
            F.col("customer_money").cast("decimal(18,2)").alias("customer_money"),
            (F.col("customer_money") * F.lit(PLATFORM_SHARE).cast("decimal(2,1)"))
            .cast("decimal(18,3)")
            .alias("platform_money"),
            "count_order",
            (F.col("customer_money").cast("double") / F.col("count_order")).alias("avg_price_order"),
            "median_time_order_completed",
            "top_product_category",
            "top_craftsman_id",
            *STATUSES,
            "count_order_not_done",
            "report_period",
        )
    )


def customer_report_incremental(
    mart: DataFrame,
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    craftsmen: DataFrame,
    since: Column,
) -> DataFrame:
    """Next version of ``mart``: customers touched after ``since`` are computed anew."""
    touched = changed_keys(
        fact,
        "customer_id",
        [(customers, "customer_id"), (products, "product_id"), (craftsmen, "craftsman_id")],
        since,
    )
    fresh = customer_report(fact.join(touched, "customer_id", "left_semi"), customers, products)
    # By customer: an order that moved to another month must not leave its old month behind.
    return mart.join(touched, "customer_id", "left_anti").unionByName(fresh)


def next_watermark(*loaded: DataFrame) -> DataFrame:
    """Greatest ``load_dttm`` over the fact and its dimensions."""
    tops = [df.agg(F.max("load_dttm").alias("load_dttm")) for df in loaded]
    united = tops[0]
    for top in tops[1:]:
        united = united.unionByName(top)
    return united.agg(F.max("load_dttm").alias("load_dttm"))
