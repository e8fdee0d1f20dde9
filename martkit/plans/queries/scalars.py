"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.functions import (
    age_years,
    hash_long,
    haversine_km,
    json_entries,
    json_items,
    json_set,
    json_text,
    local_time,
    md5_key,
    month_key,
    week_start,
)
from martkit.plans import standins as s
from martkit.plans.queries.oracle import HAVERSINE, ZONE_HOURS, with_
from martkit.plans.queries.registry import query


@query(
    "str_split_part",
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS head, split_part(p_name, ' ', -1) AS tail
    FROM part""",
)
def str_split_part(t):
    return t("part").select(
        "p_partkey",
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("head"),
        F.split_part("p_name", F.lit(" "), F.lit(-1)).alias("tail"),
    )


@query(
    "str_substr_locate",
    """SELECT p_partkey, CAST(strpos(p_name, ' ') AS INTEGER) AS blank,
        substr(p_name, strpos(p_name, ' ') + 1) AS tail FROM part""",
)
def str_substr_locate(t):
    blank = F.locate(" ", F.col("p_name"))
    return t("part").select(
        "p_partkey", blank.alias("blank"), F.substr("p_name", blank + 1).alias("tail")
    )


@query(
    "str_concat",
    """SELECT c_custkey, concat('8-800-2500-', c_custkey) AS phone,
        concat_ws(', ', c_name, c_mktsegment) AS label, c_name || '/' || c_nationkey AS path
    FROM customer""",
)
def str_concat(t):
    return t("customer").select(
        "c_custkey",
        F.concat(F.lit("8-800-2500-"), F.col("c_custkey").cast("string")).alias("phone"),
        F.concat_ws(", ", "c_name", "c_mktsegment").alias("label"),
        F.concat("c_name", F.lit("/"), F.col("c_nationkey").cast("string")).alias("path"),
    )


@query(
    "hash_md5",
    """SELECT o_orderkey, md5(o_orderkey || '|' || o_custkey || '|' ||
        coalesce(CAST(nullif(o_custkey % 3, 0) AS VARCHAR), chr(92) || 'N')) AS key FROM orders""",
)
def hash_md5(t):
    part = F.nullif(F.col("o_custkey") % 3, F.lit(0))
    return t("orders").select("o_orderkey", md5_key("o_orderkey", "o_custkey", part).alias("key"))


@query(
    "hash_link_key",
    """SELECT o_orderkey, CAST('0x' || substr(md5(o_orderkey || '|' || o_custkey), 1, 15) AS BIGINT)
        AS link_key FROM orders""",
)
def hash_link_key(t):
    return t("orders").select("o_orderkey", hash_long("o_orderkey", "o_custkey").alias("link_key"))


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(month(o_orderdate) AS INTEGER) AS month, CAST(week(o_orderdate) AS INTEGER) AS iso_week
    FROM orders""",
)
def date_parts(t):
    day = F.col("o_orderdate")
    return t("orders").select(
        "o_orderkey",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("iso_week"),
    )


@query(
    "date_trunc_week",
    """SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week_begin,
        CAST(date_trunc('month', ts) AS DATE) AS month_begin FROM events""",
)
def date_trunc_week(t):
    return t("events").select(
        "event_id",
        week_start(F.col("ts")).alias("week_begin"),
        F.to_date(F.date_trunc("month", "ts")).alias("month_begin"),
    )


@query(
    "date_month_key",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS period FROM orders",
)
def date_month_key(t):
    return t("orders").select("o_orderkey", month_key(F.col("o_orderdate")).alias("period"))


@query(
    "date_diff_days",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def date_diff_days(t):
    return s.order_lines(t).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.datediff("l_shipdate", "o_orderdate").alias("days"),
    )


@query(
    "date_age_years",
    with_("craft_customers")
    + """SELECT customer_id, CAST(date_sub('year', customer_birthday, DATE '2024-01-15') AS INTEGER)
        AS age FROM craft_customers""",
)
def date_age_years(t):
    return s.craft_customers(t).select(
        "customer_id",
        age_years(F.col("customer_birthday"), F.lit("2024-01-15").cast("date")).alias("age"),
    )


@query(
    "local_time",
    f"""SELECT event_id, strftime(ts + to_hours({ZONE_HOURS.format(n="(user_id % 25)")}),
        '%Y-%m-%d %H:%M:%S') AS local_time FROM events""",
)
def local(t):
    zone = F.element_at(
        F.array(*[F.lit(z) for z in s.ZONES]), (F.col("user_id") % 25 % 5 + 1).cast("int")
    )
    return t("events").select(
        "event_id", local_time(F.col("ts").cast("timestamp"), zone).alias("local_time")
    )


@query(
    "math_round",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(12,2)), 2)
            AS DOUBLE) AS rebate FROM lineitem""",
)
def math_round(t):
    return t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("rebate"),
    )


@query(
    "haversine_km",
    with_("geo_users")
    + f"""SELECT user_id, round({HAVERSINE('lat', 'lon', '55.75', '37.62')}, 3) AS km FROM geo_users""",
)
def haversine(t):
    return s.geo_users(t).select(
        "user_id",
        F.round(haversine_km(F.col("lat"), F.col("lon"), F.lit(55.75), F.lit(37.62)), 3).alias("km"),
    )


@query(
    "math_list_price",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE)
            / (1.0::DOUBLE - CAST(round(l_discount * 100) AS DOUBLE) / 100) AS list_price FROM lineitem""",
)
def math_list_price(t):
    percent = (F.col("l_discount") * 100).cast("double")
    return t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.try_divide(F.col("l_extendedprice").cast("double"), F.lit(1.0) - percent / 100).alias(
            "list_price"
        ),
    )


@query(
    "json_path",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
)
def json_path(t):
    return t("events").select("event_id", json_text(F.col("props"), "k").alias("k"))


@query(
    "json_each",
    "SELECT event_id, 'k' AS key, CAST(json_extract_string(props, '$.k') AS INTEGER) AS value FROM events",
)
def json_each(t):
    return t("events").select("event_id", json_entries(F.col("props"), "int"))


@query(
    "json_array_explode",
    """SELECT o_orderkey AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
        CAST(sum(l_quantity) AS INTEGER) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def json_array_explode(t):
    products = json_text(F.col("payload"), "products")
    item = json_items(products, "struct<id: string, quantity: int>")
    return (
        s.order_documents(t)
        .select(F.col("object_id").alias("order_id"), item.alias("p"))
        .select("order_id", F.col("p.id").alias("product_id"), F.col("p.quantity").alias("quantity"))
    )


@query(
    "json_set",
    """SELECT event_id, CASE WHEN k >= 50 THEN k * 2 ELSE k END AS k, event_type AS kind FROM (
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
)
def set_json(t):
    doc = F.to_json(
        F.create_map(
            F.lit("props"), F.from_json("props", "map<string,string>"),
            F.lit("meta"), F.create_map(F.lit("kind"), F.col("event_type")),
        )
    )
    k = json_text(F.col("doc"), "props", "k").cast("int")
    changed = json_set(F.col("doc"), ["props", "k"], k * 2, "map<string,map<string,string>>")
    return (
        t("events")
        .select("event_id", doc.alias("doc"))
        .select("event_id", F.when(k >= 50, changed).otherwise(F.col("doc")).alias("doc"))
        .select("event_id", k.alias("k"), json_text(F.col("doc"), "meta", "kind").alias("kind"))
    )


@query(
    "json_encode",
    """SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS value
    FROM customer""",
)
def json_encode(t):
    return t("customer").select("c_custkey", F.to_json(F.struct("c_custkey", "c_name")).alias("value"))


@query(
    "array_build",
    "SELECT c_custkey, c_name || '|' || c_mktsegment AS pair FROM customer",
)
def array_build(t):
    return t("customer").select("c_custkey", F.array("c_name", "c_mktsegment").alias("pair"))


@query(
    "struct_access",
    """SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL""",
)
def struct_access(t):
    nested = t("events").select(
        "event_type", F.struct(F.col("user_id").alias("user"), "ts", "value").alias("event")
    )
    return nested.groupBy("event_type", F.col("event.user").alias("user_id")).agg(
        F.count("*").alias("n")
    )
