"""Cities of users, activity of zones, friend recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from martkit.functions.dates import local_time, week_start
from martkit.operators.joins import join_same
from martkit.operators.pairs import co_occurring_pairs, exclude_known_pairs
from martkit.operators.points import nearest_point
from martkit.operators.select import best_per_group, latest_per_key, ordered_list
from martkit.operators.sequences import islands, longest_island

KINDS = ("message", "reaction", "subscription")


def travel_steps(
    messages: DataFrame, cities: DataFrame, chunk: Column | None = None
) -> DataFrame:
    """(user_id, step, city): the travel list in long form, one row per stay, numbered in order.

    No list is built, so a user with any number of stays spreads over tasks.
    """
    sent = messages.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "event_id", "user_id", "ts", "lat", "lon"
    )
    located = nearest_point(sent, cities, "event_id", "city_id", keep=["city"])
    stays = islands(located, ["user_id"], ["ts", "event_id"], "city", chunk)
    return stays.select("user_id", F.col("island_no").cast("bigint").alias("step"), "city")


def user_cities(
    messages: DataFrame, cities: DataFrame, min_days: int = 27, chunk: Column | None = None
) -> DataFrame:
    """Actual and home city, travels, and place and local time of the last message."""
    sent = messages.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "event_id", "user_id", "ts", "lat", "lon"
    )
    located = nearest_point(sent, cities, "event_id", "city_id", keep=["city"])
    # only the last message of each user needs a zone, so reduce before locating
    last = nearest_point(
        latest_per_key(sent, ["user_id"], ["ts", "event_id"]),
        cities,
        "event_id",
        "city_id",
        keep=["city", "timezone"],
    )
    stays = islands(located, ["user_id"], ["ts", "event_id"], "city", chunk)
    home = longest_island(stays, ["user_id"], min_days).select(
        "user_id", F.col("city").alias("home_city")
    )
    travels = (
        stays.groupBy("user_id")
        .agg(ordered_list(F.col("island_no"), F.col("city")).alias("travel_array"))
        .withColumn("travel_count", F.size("travel_array"))
    )
    return (
        last.join(home, "user_id", "left")
        .join(travels, "user_id", "left")
        .select(
            "user_id",
            F.col("city").alias("act_city"),
            "home_city",
            "travel_count",
            "travel_array",
            local_time(F.col("ts"), F.col("timezone")).alias("local_time"),
            "lat",
            "lon",
        )
    )


def status_totals(grouped: GroupedData) -> DataFrame:
    return grouped.agg(
        *[F.count_if(F.col("event_type") == k).alias(f"week_{k}") for k in KINDS]
    )


def zone_metrics(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Messages, reactions, subscriptions and new users per (zone, month, week)."""
    sent = events.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "event_id", "event_type", "user_id", "ts", "lat", "lon"
    )
    # a user's first message is found before it is located: one row per user
    firsts = best_per_group(
        sent.where((F.col("event_type") == "message") & F.col("user_id").isNotNull()),
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        largest=False,
    )
    grain = ["zone_id", "month", "week"]

    def by_zone(rows: DataFrame):
        return (
            nearest_point(rows, cities, "event_id", "city_id")
            .select(
                F.col("city_id").alias("zone_id"),
                F.to_date(F.date_trunc("month", "ts")).alias("month"),
                week_start(F.col("ts")).alias("week"),
                "event_type",
            )
            .groupBy(*grain)
        )

    weekly = status_totals(by_zone(sent))
    newcomers = by_zone(firsts).agg(F.count("*").alias("week_user"))
    counts = join_same(weekly, newcomers, grain, "left").na.fill(0, ["week_user"])
    # a month has at most six weeks, so this window only sees tiny groups
    of_month = Window.partitionBy("zone_id", "month")
    return counts.select(
        "month",
        "week",
        "zone_id",
        *[f"week_{k}" for k in (*KINDS, "user")],
        *[F.sum(f"week_{k}").over(of_month).alias(f"month_{k}") for k in (*KINDS, "user")],
    )


def friend_recommendations(
    subscriptions: DataFrame,
    messages: DataFrame,
    users: DataFrame,
    as_of: Column,
    km: float = 1.0,
) -> DataFrame:
    """Users with a common channel within ``km`` who never wrote to each other."""
    near = co_occurring_pairs(subscriptions, users, "user_id", "channel_id", km)
    strangers = exclude_known_pairs(near, messages, "message_from", "message_to")
    return strangers.join(
        users.select(F.col("user_id").alias("id_left"), "zone_id", "local_time"), "id_left", "left"
    ).select(
        F.col("id_left").alias("user_left"),
        F.col("id_right").alias("user_right"),
        as_of.alias("processed_dttm"),
        F.coalesce("zone_id", F.lit(0)).alias("zone_id"),
        F.coalesce(F.col("local_time"), as_of).alias("local_time"),
    )
