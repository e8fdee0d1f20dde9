"""Conversion of group members into message authors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.select import oldest_n


def group_conversion(
    groups: DataFrame, activity: DataFrame, messages: DataFrame, oldest: int = 10
) -> DataFrame:
    """Users added to each of the oldest groups against authors writing there."""
    order = [F.col("registration_dt").asc(), F.col("group_id").asc()]
    chosen = groups.orderBy(*order).limit(oldest).select("group_id")
    added = (
        oldest_n(activity.where(F.col("event") == "add"), groups, "group_id", order, oldest)
        .groupBy("group_id")
        .agg(F.count_distinct("user_id").alias("cnt_added_users"))
    )
    writers = (
        oldest_n(messages, groups, "group_id", order, oldest)
        .groupBy("group_id")
        .agg(F.count_distinct("user_id").alias("cnt_users_in_group_with_messages"))
    )
    filled = (
        chosen.join(added, "group_id", "left")
        .join(writers, "group_id", "left")
        .na.fill(0, ["cnt_added_users", "cnt_users_in_group_with_messages"])
    )
    share = F.try_divide(
        F.col("cnt_users_in_group_with_messages").cast("double"),
        F.col("cnt_added_users").cast("double"),
    )
    return filled.withColumn("group_conversion", F.coalesce(F.round(share, 4), F.lit(0.0))).orderBy(
        F.desc_nulls_last("group_conversion"), "group_id"
    )
