"""Domain tables of the marts, derived from the test tables.

Each function takes ``t``, a lookup from table name to frame.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.hashing import hash_long, md5_key
from martkit.functions.json import json_text
from martkit.operators.sequences import calendar_dim
from martkit.session import spread, unbroadcast

Tables = Callable[[str], DataFrame]

VENUE_TYPES = ["coffee_shop", "restaurant", "bar", "pizzeria"]
SECTIONS = ["Coffee", "Main", "Drinks", "Pizza"]
ZONES = ["UTC", "Europe/Moscow", "Asia/Tokyo", "America/New_York", "Australia/Sydney"]
CALENDAR = (date(1994, 1, 1), date(2002, 12, 31))


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _key(props: Column) -> Column:
    return json_text(props, "k").cast("int")


def order_lines(t: Tables) -> DataFrame:
    lines = spread(t("lineitem"), "l_orderkey")
    return lines.join(unbroadcast(t("orders")), F.col("l_orderkey") == F.col("o_orderkey"))


# car sales -----------------------------------------------------------------


def raw_car_sales(t: Tables) -> DataFrame:
    noun = F.split_part("p_name", F.lit(" "), F.lit(2))
    adjective = F.split_part("p_name", F.lit(" "), F.lit(1))
    return (
        order_lines(t)
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat("p_brand", F.lit(" "), noun, F.lit(", "), adjective).alias("auto"),
            F.when(F.col("p_size") % 10 == 0, "null")
            .otherwise(F.col("p_size").cast("string"))
            .alias("gasoline_consumption"),
            F.col("l_extendedprice").alias("price"),
            F.to_date("o_orderdate").alias("date"),
            F.col("c_name").alias("person_name"),
            F.concat(
                F.lit("+"),
                (F.col("c_nationkey") + 1).cast("string"),
                F.col("c_custkey").cast("string"),
            ).alias("phone"),
            (F.col("l_discount") * 100).cast("int").alias("discount"),
            F.col("n_name").alias("brand_origin"),
        )
    )


# venues --------------------------------------------------------------------


def venues(t: Tables) -> DataFrame:
    kind = F.col("s_nationkey") % 4
    items = (
        t("lineitem")
        .select("l_suppkey", "l_partkey")
        .distinct()
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_suppkey", "p_name")
        .agg(F.floor(F.max("p_retailprice")).cast("int").alias("price"))
        .groupBy("l_suppkey")
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("p_name", "price")))).alias(
                "items"
            )
        )
    )
    return (
        t("supplier")
        .join(items, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .select(
            F.col("s_suppkey").alias("venue_id"),
            F.col("s_name").alias("cafe_name"),
            _pick(VENUE_TYPES, kind).alias("type"),
            F.when(
                F.col("items").isNotNull(),
                F.to_json(F.create_map(_pick(SECTIONS, kind), F.col("items"))),
            ).alias("menu"),
        )
    )


def venue_names(t: Tables) -> DataFrame:
    """Venues without menus."""
    return t("supplier").select(
        F.col("s_suppkey").alias("venue_id"),
        F.col("s_name").alias("cafe_name"),
        _pick(VENUE_TYPES, F.col("s_nationkey") % 4).alias("type"),
    )


def venue_sales(t: Tables) -> DataFrame:
    """Average bill per (day, venue), in whole cents."""
    cents = (F.col("l_extendedprice") * 100).cast("bigint")
    daily = (
        order_lines(t)
        .groupBy("l_suppkey", F.to_date("o_orderdate").alias("date"), "o_orderkey")
        .agg(F.sum(cents).alias("bill"))
        .groupBy("l_suppkey", "date")
        .agg(F.sum("bill").alias("total"), F.count("*").alias("n"))
    )
    return daily.select(
        "date",
        F.col("l_suppkey").alias("venue_id"),
        (F.expr("total div n") * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(14,2)")
        .alias("avg_check"),
    )


def venue_work_days(t: Tables) -> DataFrame:
    return order_lines(t).select(
        F.col("l_suppkey").alias("venue_id"),
        (F.col("o_custkey") % 50).alias("manager"),
        F.to_date("o_orderdate").alias("date"),
    )


def managers(t: Tables) -> DataFrame:
    return t("customer").select(
        F.col("c_name").alias("manager"),
        F.concat(F.lit("8-9"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("phone"),
    )


# craft orders ---------------------------------------------------------------

_FIRST_LOAD = "1995-01-01 00:00:00"


def _person(prefix: str, key: str, name: str) -> list[Column]:
    return [
        F.col(key).alias(f"{prefix}_id"),
        F.col(name).alias(f"{prefix}_name"),
        F.concat(F.lit("Street "), (F.col(key) % 97).cast("string")).alias(f"{prefix}_address"),
        F.date_add(F.lit("1960-01-01").cast("date"), (F.col(key) % 10000).cast("int")).alias(
            f"{prefix}_birthday"
        ),
        F.concat(F.lower(F.regexp_replace(name, "#", ".")), F.lit("@example.org")).alias(
            f"{prefix}_email"
        ),
    ]


def craft_customers(t: Tables) -> DataFrame:
    loaded = F.lit(_FIRST_LOAD).cast("timestamp_ntz").alias("load_dttm")
    return t("customer").select(*_person("customer", "c_custkey", "c_name"), loaded)


def craft_craftsmen(t: Tables) -> DataFrame:
    loaded = F.lit(_FIRST_LOAD).cast("timestamp_ntz").alias("load_dttm")
    return t("supplier").select(*_person("craftsman", "s_suppkey", "s_name"), loaded)


def craft_products(t: Tables) -> DataFrame:
    return t("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat_ws(" ", "p_brand", "p_name").alias("product_description"),
        F.col("p_type").alias("product_type"),
        F.col("p_retailprice").alias("list_price"),
        F.lit(_FIRST_LOAD).cast("timestamp_ntz").alias("load_dttm"),
    )


def _craft_status() -> Column:
    state = F.col("o_orderstatus")
    return (
        F.when(state == "F", "done")
        .when(state == "P", "in progress")
        .when(F.col("l_returnflag") == "A", "delivery")
        .otherwise("created")
    )


def craft_fact(t: Tables) -> DataFrame:
    return order_lines(t).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("craftsman_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_extendedprice").alias("product_price"),
        F.to_date("o_orderdate").alias("order_created_date"),
        F.to_date("l_shipdate").alias("order_completion_date"),
        _craft_status().alias("order_status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("load_dttm"),
    )


def craft_sources(t: Tables) -> list[tuple[DataFrame, dict[str, str]]]:
    """Four differently named sources with 19 columns each, and their mappings."""
    wide = (
        craft_fact(t)
        .drop("load_dttm")
        .join(unbroadcast(craft_customers(t).drop("load_dttm")), "customer_id")
        .join(unbroadcast(craft_craftsmen(t).drop("load_dttm")), "craftsman_id")
        .join(unbroadcast(craft_products(t).drop("load_dttm", "list_price")), "product_id")
    )
    names = sorted(wide.columns)
    out = []
    for i, prefix in enumerate(["", "market_", "shop_", "web_"]):
        part = wide.where(F.col("order_id") % 4 == i).select(
            *[F.col(n).alias(prefix + n) for n in names]
        )
        out.append((part, {n: prefix + n for n in names}))
    return out


# retail log ----------------------------------------------------------------


def user_order_log(t: Tables) -> DataFrame:
    """Raw order log; every row appears twice, as after a repeated delivery."""
    rows = (
        order_lines(t)
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        F.explode(F.array(F.lit(1), F.lit(2))).alias("id"),
        md5_key(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.to_date("l_shipdate"),
            "l_extendedprice",
        ).alias("uniq_id"),
        F.to_date("l_shipdate").cast("timestamp_ntz").alias("date_time"),
        F.col("l_partkey").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("o_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("n_nationkey").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("payment_amount"),
        F.when(F.col("l_returnflag") == "R", "refunded").otherwise("shipped").alias("status"),
    )


def calendar_of(days: DataFrame, day: str) -> DataFrame:
    """Calendar from the first to the last ``day`` of ``days``."""
    ends = days.agg(F.min(day).alias("low"), F.max(day).alias("high")).first()
    return calendar_dim(days.sparkSession, *(CALENDAR if ends.low is None else (ends.low, ends.high)))


# courier deliveries ---------------------------------------------------------


def deliveries(t: Tables) -> DataFrame:
    return (
        t("lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.min("l_suppkey").alias("courier_id"))
        .select(
            F.md5(F.col("order_id").cast("string")).alias("delivery_id"),
            "order_id",
            "courier_id",
            (F.col("order_id") % 5 + 1).cast("int").alias("rate"),
            (F.col("order_id") % 300).cast("decimal(14,2)").alias("tip_sum"),
        )
    )


def courier_orders(t: Tables) -> DataFrame:
    return t("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_ts")
    )


def product_sales(t: Tables) -> DataFrame:
    return t("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("total_sum")
    )


def couriers(t: Tables) -> DataFrame:
    return t("supplier").select(
        F.col("s_suppkey").alias("courier_id"), F.col("s_name").alias("courier_name")
    )


# groups ---------------------------------------------------------------------


def group_events(t: Tables) -> DataFrame:
    return t("events").select(
        "event_id", "user_id", "event_type", "ts", _key(F.col("props")).alias("group_id")
    )


def groups(t: Tables) -> DataFrame:
    return group_events(t).groupBy("group_id").agg(F.min("ts").alias("registration_dt"))


def group_log(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return (
        group_events(t)
        .where(kind.isin("signup", "error"))
        .select(
            "event_id",
            "group_id",
            "user_id",
            F.when(F.col("user_id") % 7 != 0, F.col("user_id") % 7).alias("user_id_from"),
            F.when(kind == "signup", "add").otherwise("leave").alias("event"),
            F.col("ts").alias("datetime"),
        )
    )


def group_messages(t: Tables) -> DataFrame:
    return group_events(t).where(F.col("event_type").isin("purchase", "click")).select(
        "group_id", "user_id"
    )


# geography ------------------------------------------------------------------


def cities(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    return t("nation").select(
        n.alias("city_id"),
        F.col("n_name").alias("city"),
        (n * 37 % 120 - 60).cast("double").alias("lat"),
        (n * 91 % 340 - 170).cast("double").alias("lon"),
        _pick(ZONES, n % 5).alias("timezone"),
    )


def geo_events(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    moves = F.when(F.col("user_id") % 2 == 0, 0).otherwise(F.floor(F.dayofmonth("ts") / 10))
    city = (F.col("user_id") + moves) % 25
    offset = (F.col("event_id") % 100).cast("double") / 1000.0
    key = _key(F.col("props"))
    return t("events").select(
        "event_id",
        "user_id",
        "ts",
        F.when(kind.isin("click", "purchase"), "message")
        .when(kind.isin("view", "error"), "reaction")
        .otherwise("subscription")
        .alias("event_type"),
        ((city * 37 % 120 - 60).cast("double") + offset).alias("lat"),
        ((city * 91 % 340 - 170).cast("double") + offset).alias("lon"),
        key.alias("channel_id"),
        F.when(kind.isin("click", "purchase"), F.col("user_id") + 25 * (key % 40)).alias("message_to"),
    )


def geo_messages(t: Tables) -> DataFrame:
    return geo_events(t).where(F.col("event_type") == "message")


def geo_users(t: Tables) -> DataFrame:
    """One point per user: users of a city stand on a lattice about 0.4 km wide."""
    user = F.col("user_id")
    city = (user % 25).cast("int")
    place = F.floor(user / 25)
    last = t("events").groupBy("user_id").agg(F.max("ts").alias("ts"))
    return last.select(
        "user_id",
        ((city * 37 % 120 - 60).cast("double") + (place % 1000).cast("double") * 0.004).alias("lat"),
        (
            (city * 91 % 340 - 170).cast("double") + F.floor(place / 1000).cast("double") * 0.004
        ).alias("lon"),
        city.alias("zone_id"),
        F.from_utc_timestamp(F.col("ts").cast("timestamp"), _pick(ZONES, city % 5)).alias(
            "local_time"
        ),
    )


def channel_subscriptions(t: Tables) -> DataFrame:
    return t("events").where(F.col("event_type") == "signup").select(
        "user_id", _key(F.col("props")).alias("channel_id")
    )


# campaigns ------------------------------------------------------------------


def campaigns(t: Tables) -> DataFrame:
    start = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return (
        t("events")
        .where(F.col("event_type") == "purchase")
        .select(
            json_text(F.col("props"), "k").alias("restaurant_id"),
            F.col("event_id").cast("string").alias("adv_campaign_id"),
            F.concat(F.lit("Campaign "), F.col("event_id").cast("string")).alias(
                "adv_campaign_content"
            ),
            F.concat(F.lit("Owner "), F.col("user_id").cast("string")).alias("adv_campaign_owner"),
            F.concat(F.col("user_id").cast("string"), F.lit("@example.org")).alias(
                "adv_campaign_owner_contact"
            ),
            start.alias("adv_campaign_datetime_start"),
            (start + (F.col("event_id") % 10 + 1) * 86400).alias("adv_campaign_datetime_end"),
            start.alias("datetime_created"),
        )
    )


def subscribers(t: Tables) -> DataFrame:
    return (
        t("events")
        .where(F.col("event_type") == "view")
        .select(
            F.col("user_id").cast("string").alias("client_id"),
            json_text(F.col("props"), "k").alias("restaurant_id"),
        )
        .distinct()
    )


# order documents ------------------------------------------------------------


def order_documents(
    t: Tables, status: str = "o_orderstatus", user_name: str = "c_name"
) -> DataFrame:
    """Order documents; ``status`` and ``user_name`` are SQL expressions.

    Customer and supplier meet the order before its basket does: baskets are wide
    and would be shuffled once more for each.
    """
    sold = F.col("l_partkey") == F.col("p_partkey")
    lines = (
        t("lineitem")
        .groupBy("l_orderkey", "l_partkey")
        .agg(F.sum("l_quantity").cast("int").alias("quantity"))
        .join(t("part"), sold)
    )
    served = (
        t("lineitem")
        .join(t("part"), sold, "left_semi")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("supplier"))
        .join(t("supplier"), F.col("supplier") == F.col("s_suppkey"))
        .select(F.col("l_orderkey").alias("served_order"), "s_suppkey", "s_name")
    )
    product = F.struct(
        F.col("l_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        "quantity",
    )
    baskets = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(product)).alias("products"))
    return (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(served, F.col("o_orderkey") == F.col("served_order"))
        .join(baskets, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("o_orderkey").alias("object_id"),
            F.to_json(
                F.struct(
                    F.col("o_orderkey").alias("id"),
                    F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
                    F.col("o_totalprice").alias("cost"),
                    F.col("o_totalprice").alias("payment"),
                    F.expr(status).alias("status"),
                    F.struct(
                        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name")
                    ).alias("restaurant"),
                    F.struct(
                        F.col("c_custkey").cast("string").alias("id"), F.expr(user_name).alias("name")
                    ).alias("user"),
                    "products",
                )
            ).alias("payload"),
        )
    )


def order_messages(t: Tables) -> DataFrame:
    """Enveloped order messages with their arrival; every order comes twice, odd ones last."""

    def sent(documents: DataFrame, hour: Column) -> DataFrame:
        head = F.concat(F.lit('{"object_id":'), "object_id", F.lit(',"object_type":"order","payload":'))
        return documents.select(
            F.concat(head, "payload", F.lit("}")).alias("payload"),
            (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=hour)).alias("timestamp"),
            F.col("object_id").alias("offset"),
        )

    opened = order_documents(t, "'OPEN'", "'nobody'")
    closed = order_documents(t, user_name="concat(c_name, '/', o_orderkey)")
    return sent(opened, F.lit(1)).unionByName(sent(closed, (F.col("object_id") % 2 + 2).cast("int")))


def broken_messages(t: Tables) -> DataFrame:
    """Messages that are no order: a value of a wrong type, no JSON, no text."""
    key = F.col("o_orderkey").cast("string")
    wrong = F.concat(F.lit('{"payload":{"id":'), key, F.lit(',"cost":"abc"}}'))
    text = F.when(F.col("o_orderkey") % 3 == 0, wrong).when(
        F.col("o_orderkey") % 3 == 1, F.concat(F.lit("order "), key)
    ).otherwise("")
    return t("orders").where("o_orderkey % 97 = 0").select(
        text.alias("payload"),
        F.lit("2024-01-02 00:00:00").cast("timestamp").alias("timestamp"),
        F.col("o_orderkey").alias("offset"),
    )


# transactions ---------------------------------------------------------------


def transactions(t: Tables) -> DataFrame:
    account = F.col("o_custkey")
    return (
        t("orders")
        .join(t("customer"), account == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("operation_id"),
            F.when(account % 50 == 0, -account - 1).otherwise(account).alias("account_number_from"),
            F.col("c_nationkey").alias("currency_code"),
            F.when(F.col("o_orderstatus") == "F", "done").otherwise("queued").alias("status"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderdate").alias("transaction_dt"),
        )
    )


def currency_rates(t: Tables) -> DataFrame:
    """Rate of every currency into currency 0, for every day from the first to the last order."""
    ends = t("orders").agg(F.min(F.to_date("o_orderdate")).alias("low"), F.max(F.to_date("o_orderdate")).alias("high")).first()
    first, last = CALENDAR if ends.low is None else (ends.low, ends.high)
    return t("nation").select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date_update"),
        F.col("n_nationkey").alias("currency_code"),
        F.lit(0).alias("currency_code_with"),
        ((F.col("n_nationkey") % 9 + 1) * F.lit("0.125").cast("decimal(5,3)"))
        .cast("decimal(5,3)")
        .alias("currency_with_div"),
    )


# cars -----------------------------------------------------------------------


def _model_id() -> Column:
    return hash_long("p_brand", F.split_part("p_name", F.lit(" "), F.lit(2)))


def _vin(key: str) -> Column:
    return F.concat(F.lit("VIN"), F.lpad(F.col(key).cast("string"), 12, "0"))


def cars(t: Tables) -> DataFrame:
    return t("part").select(
        _vin("p_partkey").alias("vin"),
        _model_id().alias("model"),
        F.col("p_retailprice").alias("price"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")).alias("date_start"),
        _pick(["available", "reserve", "delivery"], F.col("p_size") % 3).alias("status"),
    )


def car_models(t: Tables) -> DataFrame:
    return (
        t("part")
        .select(
            _model_id().alias("id"),
            F.split_part("p_name", F.lit(" "), F.lit(2)).alias("name"),
            F.col("p_brand").alias("brand"),
        )
        .distinct()
    )


def car_sales(t: Tables) -> DataFrame:
    """One sale per (day, car): the highest price of that day."""
    return (
        t("lineitem")
        .groupBy("l_partkey", F.to_date("l_shipdate").alias("sales_date"))
        .agg(F.max("l_extendedprice").alias("cost"))
        .select(
            F.concat(
                F.date_format("sales_date", "yyyyMMdd"), F.lit("#"), _vin("l_partkey")
            ).alias("sales_number"),
            _vin("l_partkey").alias("car_vin"),
            "sales_date",
            "cost",
        )
    )
