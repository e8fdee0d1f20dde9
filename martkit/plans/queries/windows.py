"""Window operators, sequences and ordinals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from martkit.operators.load import load_next_batch
from martkit.operators.ordinals import assign_ids, global_ordinal
from martkit.operators.points import nearest_point
from martkit.operators.select import (
    active_at,
    best_per_group,
    flag_first,
    ranked_first,
    top_k_per_group,
)
from martkit.operators.sequences import change_points, islands, longest_island, ordinal_within
from martkit.plans import standins as s
from martkit.plans.queries.oracle import with_
from martkit.plans.queries.registry import query


@query(
    "top_k_per_group",
    """SELECT o_custkey, o_orderkey, CAST(row_no AS INTEGER) AS row_no FROM (
        SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
            ORDER BY CAST(o_totalprice AS DECIMAL(12,2)) DESC, o_orderkey) AS row_no FROM orders)
    WHERE row_no <= 3""",
)
def top_k(t):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return top_k_per_group(t("orders"), ["o_custkey"], order, 3).select(
        "o_custkey", "o_orderkey", "row_no"
    )


@query(
    "best_per_group",
    """SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber FROM (
        SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY
            CAST(l_extendedprice AS DECIMAL(12,2)) DESC, l_orderkey DESC, l_linenumber DESC,
            l_partkey DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def best(t):
    rows = t("lineitem").select(
        "l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"
    )
    order = [F.col(c) for c in ("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey")]
    return best_per_group(rows, ["l_suppkey"], order).drop("l_extendedprice")


@query(
    "first_event_flag",
    """SELECT event_id, CAST(event_type = 'click' AND row_number() OVER (
            PARTITION BY user_id, event_type = 'click' ORDER BY ts, event_id) = 1 AS INTEGER) AS is_new_user
    FROM events""",
)
def first_event_flag(t):
    return flag_first(
        t("events"),
        "user_id",
        ["ts", "event_id"],
        "event_id",
        where=F.col("event_type") == "click",
        name="is_new_user",
    ).select("event_id", "is_new_user")


@query(
    "win_rank",
    """SELECT o_custkey, p_type, n, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY n DESC)
        AS INTEGER) AS place FROM (SELECT o_custkey, p_type, count(*) AS n FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)""",
)
def win_rank(t):
    # groups hold one row per product type, so the window sees few rows per key
    counts = (
        s.order_lines(t)
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("o_custkey", "p_type")
        .agg(F.count("*").alias("n"))
    )
    window = Window.partitionBy("o_custkey").orderBy(F.desc("n"))
    return counts.withColumn("place", F.rank().over(window))


@query(
    "win_dense_rank",
    """SELECT p_brand, p_partkey, p_size FROM (SELECT *, dense_rank() OVER (
        PARTITION BY p_brand ORDER BY p_size DESC) AS place FROM part) WHERE place = 1""",
)
def win_dense_rank(t):
    return ranked_first(t("part"), ["p_brand"], "p_size").select("p_brand", "p_partkey", "p_size")


@query(
    "win_row_number",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
        AS visit_order FROM events""",
)
def win_row_number(t):
    return ordinal_within(
        t("events").select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"], "visit_order"
    ).drop("ts")


@query(
    "change_points",
    """SELECT event_id, user_id, previous, event_type FROM (SELECT *, lag(event_type) OVER (
        PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
    WHERE previous IS NOT NULL AND previous <> event_type""",
)
def changes(t):
    rows = t("events").select("event_id", "user_id", "ts", "event_type")
    return change_points(rows, ["user_id"], ["ts", "event_id"], "event_type").drop("ts")


_ISLANDS = """WITH steps AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1
        END AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    runs AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM steps)
    """


@query(
    "islands",
    _ISLANDS
    + """SELECT user_id, CAST(no AS BIGINT) AS island_no, min(event_type) AS event_type,
        strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started,
        strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended, count(*) AS row_count
    FROM runs GROUP BY user_id, no""",
)
def runs(t):
    return islands(t("events"), ["user_id"], ["ts", "event_id"], "event_type")


@query(
    "longest_stay",
    with_(
        "geo_city",
        steps="""SELECT *, CASE WHEN lag(city) OVER w = city THEN 0 ELSE 1 END AS starts
            FROM geo_city WHERE kind = 'message'
            WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
        runs="""SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no
            FROM steps""",
        stays="""SELECT user_id, no, min(city) AS city, CAST(min(ts) AS DATE) AS started,
            CAST(max(ts) AS DATE) AS ended, min(ts) AS started_ts,
            date_diff('day', min(ts)::DATE, max(ts)::DATE) AS stay_days
            FROM runs GROUP BY user_id, no""",
    )
    + """SELECT user_id, city, started, ended, CAST(stay_days AS INTEGER) AS stay_days FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY stay_days DESC,
            started_ts DESC) AS rn FROM stays WHERE stay_days >= 5) WHERE rn = 1""",
)
def longest_stay(t):
    located = nearest_point(s.geo_messages(t), s.cities(t), "event_id", "city_id", keep=["city"])
    stays = islands(located, ["user_id"], ["ts", "event_id"], "city")
    return longest_island(stays, ["user_id"], 5).select(
        "user_id",
        "city",
        F.to_date("started").alias("started"),
        F.to_date("ended").alias("ended"),
        "stay_days",
    )


@query(
    "global_ordinal",
    """SELECT o_orderkey, 99 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS ordinal
    FROM orders""",
)
def ordinal(t):
    rows = t("orders").select("o_orderkey", "o_orderdate")
    return global_ordinal(rows, ["o_orderdate", "o_orderkey"], start=100).drop("o_orderdate")


@query(
    "assign_ids",
    """SELECT c_name, row_number() OVER (ORDER BY c_nationkey >= 12, c_name) AS customer_id
    FROM customer""",
)
def ids(t):
    names = t("customer").select("c_name", "c_nationkey")
    first = assign_ids(
        names.where(F.col("c_nationkey") < 12).select("c_name"), None, "customer_id", ["c_name"]
    )
    later = assign_ids(
        names.where(F.col("c_nationkey") >= 12).select("c_name"), first, "customer_id", ["c_name"]
    )
    return first.unionByName(later)


@query(
    "keyset_batch",
    """SELECT o_orderkey, 'orders' AS workflow, (SELECT max(o_orderkey) FROM (SELECT o_orderkey
            FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 1000)) AS last_id
    FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 1000""",
)
def keyset(t):
    state = t.spark.createDataFrame(
        [("orders", 1000), ("couriers", 7)], "workflow string, last_id bigint"
    )
    batch, progress = load_next_batch(t("orders"), state, "orders", "o_orderkey", 1000)
    reached = progress.where(F.col("workflow") == "orders").select("last_id").scalar()
    return batch.select(
        "o_orderkey", F.lit("orders").alias("workflow"), reached.alias("last_id")
    )


@query(
    "active_campaigns",
    with_("campaigns")
    + """SELECT adv_campaign_id, restaurant_id FROM campaigns
    WHERE adv_campaign_datetime_start <= 1705276800 AND 1705276800 < adv_campaign_datetime_end""",
)
def active(t):
    as_of = F.lit(1705276800)  # 2024-01-15 00:00 UTC
    running = active_at(
        s.campaigns(t), "adv_campaign_datetime_start", "adv_campaign_datetime_end", as_of
    )
    return running.select("adv_campaign_id", "restaurant_id")
