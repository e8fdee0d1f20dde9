"""Restaurant venues: bills, managers, menus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martkit.functions.json import json_set, json_text
from martkit.operators.ordinals import global_ordinal
from martkit.operators.select import best_per_group, ranked_first, top_k_per_group

# Prefix and first number of the new phones, the price rise.
PHONE_PREFIX = "8-800-2500-"
FIRST_PHONE = 100
PRICE_RISE = "1.2"
MENU = "map<string,map<string,int>>"


def _average_bill(sales: DataFrame, *by) -> DataFrame:
    return sales.groupBy("venue_id", *by).agg(
        (F.sum("avg_check") / F.count("*")).alias("average")
    )


def venue_top(sales: DataFrame, venues: DataFrame, k: int = 3) -> DataFrame:
    """Best ``k`` venues of each type by average bill."""
    bills = _average_bill(sales).join(venues.select("venue_id", "cafe_name", "type"), "venue_id")
    top = top_k_per_group(bills, ["type"], [F.desc("average"), F.asc("venue_id")], k)
    return top.select("cafe_name", "type", F.round("average", 2).alias("average_check"))


def yoy_change(sales: DataFrame, venues: DataFrame, before: int = 2023) -> DataFrame:
    """Average bill per venue and year against the year before it in the data."""
    bills = _average_bill(sales.withColumn("year", F.year("date")).where(F.col("year") < before), "year")
    previous = F.lag("average").over(Window.partitionBy("venue_id").orderBy("year"))
    now, then = F.col("average").cast("double"), F.col("previous").cast("double")
    change = F.try_divide(now - then, then) * 100
    return (
        bills.withColumn("previous", previous)
        .join(venues.select("venue_id", "cafe_name", "type"), "venue_id")
        .select(
            "year",
            "cafe_name",
            "type",
            F.round("average", 2).alias("average_check_current_year"),
            F.round("previous", 2).alias("average_check_previous_year"),
            F.round(change, 2).alias("percentage_change"),
        )
    )


def tenure_spans(days: DataFrame) -> DataFrame:
    """First and last working day per (venue, manager)."""
    return days.groupBy("venue_id", "manager").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date")
    )


def manager_changes(spans: DataFrame, venues: DataFrame, k: int = 3) -> DataFrame:
    """Venues with the most managers; the name decides a tie."""
    counts = spans.groupBy("venue_id").agg(F.count("*").alias("times_manager_changed"))
    return (
        counts.join(venues.select("venue_id", "cafe_name"), "venue_id")
        .orderBy(F.desc("times_manager_changed"), F.asc("cafe_name"))
        .limit(k)
        .select("cafe_name", "times_manager_changed")
    )


def menu_items(venues: DataFrame, venue_type: str, section: str) -> DataFrame:
    """Items and prices of one menu section."""
    return (
        venues.where(F.col("type") == venue_type)
        .select("venue_id", "cafe_name", F.from_json("menu", MENU)[section].alias("items"))
        .select("venue_id", "cafe_name", F.explode("items").alias("item", "price"))
    )


def menu_largest(venues: DataFrame, venue_type: str, section: str) -> DataFrame:
    """Venues with the most items in a section, ties kept."""
    counts = menu_items(venues, venue_type, section).groupBy("venue_id", "cafe_name").agg(
        F.count("*").alias("number_of_items")
    )
    return ranked_first(counts, [], "number_of_items").select("cafe_name", "number_of_items")


def menu_priciest(venues: DataFrame, venue_type: str, section: str) -> DataFrame:
    """Most expensive item per venue; the first name decides a tie."""
    items = menu_items(venues, venue_type, section)
    best = best_per_group(
        items, ["venue_id", "cafe_name"], [-F.col("price"), F.col("item")], largest=False
    )
    return best.select("cafe_name", F.lit(section).alias("dish_type"), "item", "price")


def raise_price(venues: DataFrame, venue_type: str, section: str, item: str) -> DataFrame:
    """Menus of a venue type with one item 20 % dearer where it has a price."""
    price = json_text(F.col("menu"), section, item).cast("int")
    dearer = (price * F.lit(PRICE_RISE).cast("decimal(2,1)")).cast("double")
    schema = "map<string,map<string,double>>"
    hit = (F.col("type") == venue_type) & (price > 0)
    return venues.withColumn(
        "menu",
        F.when(hit, json_set(F.col("menu"), [section, item], dearer, schema)).otherwise(
            F.col("menu")
        ),
    )


def phone_migration(managers: DataFrame) -> DataFrame:
    """Scalar phone to [new number, old phone], numbered by manager name."""
    numbered = global_ordinal(managers, ["manager", "phone"], "number", FIRST_PHONE)
    return numbered.withColumn(
        "phones",
        F.array(F.concat(F.lit(PHONE_PREFIX), F.col("number").cast("string")), F.col("phone")),
    ).drop("phone", "number")
