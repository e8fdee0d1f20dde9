"""Projections, filters, set operations, sorting and row rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from martkit.operators.load import conform_union
from martkit.operators.ordinals import global_ordinal
from martkit.operators.quality import (
    ensure_columns,
    find_duplicates,
    find_orphans,
    one_of,
    split_valid,
    text_length,
)
from martkit.operators.select import latest_per_key, oldest_n, signed_amount, slice_by_date
from martkit.plans import standins as s
from martkit.plans.queries.oracle import with_
from martkit.plans.queries.registry import query


@query(
    "project_literal",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, 's3' AS load_src,
        1 AS version FROM customer""",
)
def project_literal(t):
    return t("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.lit("s3").alias("load_src"),
        F.lit(1).alias("version"),
    )


@query(
    "filter_range",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'
        AND o_orderstatus = 'F'""",
)
def filter_range(t):
    day = F.col("o_orderdate")
    return (
        t("orders")
        .where(
            (day >= F.lit("1997-01-01").cast("timestamp_ntz"))
            & (day < F.lit("1998-01-01").cast("timestamp_ntz"))
            & (F.col("o_orderstatus") == "F")
        )
        .select("o_orderkey", F.to_date(day).alias("order_date"))
    )


@query(
    "filter_in",
    """SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'SMALL')""",
)
def filter_in(t):
    return t("part").where(F.col("p_type").isin("ECONOMY", "SMALL")).select("p_partkey", "p_type")


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def filter_like(t):
    return t("part").where(F.col("p_name").like("red%")).select("p_partkey", "p_name")


@query(
    "filter_null",
    """SELECT event_type, count(*) FILTER (WHERE nullif(user_id % 7, 0) IS NULL) AS unknown_rows,
        count(*) FILTER (WHERE nullif(user_id % 7, 0) IS NOT NULL) AS known_rows
    FROM events GROUP BY event_type""",
)
def filter_null(t):
    source = F.nullif(F.col("user_id") % 7, F.lit(0))
    return t("events").groupBy("event_type").agg(
        F.count_if(source.isNull()).alias("unknown_rows"),
        F.count_if(source.isNotNull()).alias("known_rows"),
    )


@query(
    "slice_by_date",
    """SELECT event_id, user_id FROM events
    WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'""",
)
def slice_day(t):
    return slice_by_date(t("events"), "ts", date(2024, 1, 15)).select("event_id", "user_id")


@query(
    "case_tier",
    """SELECT c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low'
        ELSE 'high' END AS tier, count(*) AS customers FROM customer GROUP BY ALL""",
)
def case_tier(t):
    balance = F.col("c_acctbal")
    tier = F.when(balance < 0, "debt").when(balance < 5000, "low").otherwise("high")
    return t("customer").groupBy("c_mktsegment", tier.alias("tier")).agg(
        F.count("*").alias("customers")
    )


@query(
    "coalesce_nullif",
    """SELECT event_id, coalesce(nullif(user_id % 7, 0), -1) AS user_id_from FROM events""",
)
def coalesce_nullif(t):
    return t("events").select(
        "event_id",
        F.coalesce(F.nullif(F.col("user_id") % 7, F.lit(0)), F.lit(-1)).alias("user_id_from"),
    )


@query(
    "greatest_floor",
    """SELECT o_orderkey, CAST(greatest(CAST(o_totalprice AS DECIMAL(12,2)) * 0.05, 10000)
        AS DOUBLE) AS fee,
        greatest(nullif(o_custkey % 3, 0), o_orderkey % 5) AS larger FROM orders""",
)
def greatest_floor(t):
    share = F.col("o_totalprice") * F.lit("0.05").cast("decimal(3,2)")
    return t("orders").select(
        "o_orderkey",
        F.greatest(share, F.lit(10000).cast("decimal(16,4)")).alias("fee"),
        F.greatest(F.nullif(F.col("o_custkey") % 3, F.lit(0)), F.col("o_orderkey") % 5).alias(
            "larger"
        ),
    )


@query(
    "scalar_subquery",
    """SELECT o_orderkey FROM orders WHERE o_orderdate > (SELECT
        coalesce(max(o_orderdate), DATE '1900-01-01') FROM orders WHERE o_orderdate < DATE '1998-01-01')""",
)
def scalar_subquery(t):
    orders = t("orders")
    day = F.col("o_orderdate")
    loaded = orders.where(day < F.lit("1998-01-01").cast("timestamp_ntz")).agg(
        F.coalesce(F.max(day), F.lit("1900-01-01").cast("timestamp_ntz"))
    )
    return orders.where(day > loaded.scalar()).select("o_orderkey")


@query(
    "oldest_n_semi",
    with_("group_reg")
    + """SELECT event_id, group_id FROM group_events WHERE group_id IN
        (SELECT group_id FROM group_reg ORDER BY registration_dt, group_id LIMIT 10)""",
)
def oldest_n_semi(t):
    order = [F.col("registration_dt"), F.col("group_id")]
    return oldest_n(s.group_events(t), s.groups(t), "group_id", order, 10).select(
        "event_id", "group_id"
    )


@query(
    "anti_missing_dim",
    """SELECT DISTINCT p_type, p_brand FROM part WHERE NOT EXISTS (
        SELECT 1 FROM (SELECT DISTINCT p_brand AS known FROM part WHERE p_type = 'SMALL'
            AND p_size > 40) WHERE known = p_brand)""",
)
def anti_missing_dim(t):
    part = t("part")
    known = part.where((F.col("p_type") == "SMALL") & (F.col("p_size") > 40)).select(
        F.col("p_brand").alias("known")
    )
    return (
        part.select("p_type", "p_brand")
        .distinct()
        .join(known.distinct(), F.col("known") == F.col("p_brand"), "left_anti")
    )


@query(
    "ensure_columns",
    "SELECT o_orderstatus, 'shipped' AS status, count(*) AS n FROM orders GROUP BY ALL",
)
def ensure_cols(t):
    rows = ensure_columns(
        t("orders"), {"status": F.lit("shipped"), "o_orderstatus": F.lit("unused")}
    )
    return rows.groupBy("o_orderstatus", "status").agg(F.count("*").alias("n"))


@query(
    "casts",
    """SELECT event_id, CAST(event_id AS VARCHAR) AS as_text, CAST(ts AS DATE) AS as_date,
        CAST(trunc(value) AS INTEGER) AS as_int, CAST(value AS DECIMAL(10,2))::DOUBLE AS as_money,
        coalesce(TRY_CAST(event_type AS INTEGER), -1) AS bad_cast,
        CAST(json_extract_string(props, '$.k') AS DOUBLE) AS as_double FROM events""",
)
def casts(t):
    return t("events").select(
        "event_id",
        F.col("event_id").cast("string").alias("as_text"),
        F.col("ts").cast("date").alias("as_date"),
        F.col("value").cast("int").alias("as_int"),
        F.col("value").cast("decimal(10,2)").alias("as_money"),
        F.coalesce(F.col("event_type").try_cast("int"), F.lit(-1)).alias("bad_cast"),
        F.get_json_object("props", "$.k").cast("double").alias("as_double"),
    )


@query(
    "quality_rules",
    """SELECT failed_rules, count(*) AS n FROM (
        SELECT concat_ws('|',
            CASE WHEN NOT (l_quantity BETWEEN 5 AND 45) THEN 'quantity_range' END,
            CASE WHEN NOT (l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '2001-01-01')
                THEN 'ship_date' END,
            CASE WHEN NOT (l_returnflag IN ('A', 'N')) THEN 'flag_known' END,
            CASE WHEN NOT (length(l_linestatus) <= 1) THEN 'status_length' END) AS failed_rules
        FROM lineitem) GROUP BY failed_rules""",
)
def quality_rules(t):
    day = F.col("l_shipdate")
    good, bad = split_valid(
        t("lineitem"),
        {
            "quantity_range": F.col("l_quantity").between(5, 45),
            "ship_date": (day >= F.lit("1996-01-01").cast("timestamp_ntz"))
            & (day < F.lit("2001-01-01").cast("timestamp_ntz")),
            "flag_known": one_of("l_returnflag", ["A", "N"]),
            "status_length": text_length("l_linestatus", 1),
        },
    )
    accepted = good.agg(F.count("*").alias("n")).select(F.lit("").alias("failed_rules"), "n")
    rejected = bad.groupBy(F.array_join("failed_rules", "|").alias("failed_rules")).agg(
        F.count("*").alias("n")
    )
    return accepted.unionByName(rejected)


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys(t):
    return find_duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "orphan_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
)
def orphan_keys(t):
    parents = t("supplier").where(F.col("s_acctbal") >= 0)
    return find_orphans(t("lineitem"), parents, ["l_suppkey"], ["s_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query("distinct_dim", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_dim(t):
    return t("part").select("p_brand", "p_type").distinct()


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest(t):
    rows = t("orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    return latest_per_key(rows, ["o_custkey"], ["order_date", "o_orderkey"])


@query(
    "signed_amount",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        CAST(CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(12,2))
            ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS DOUBLE) AS l_extendedprice
    FROM lineitem""",
)
def signed(t):
    return signed_amount(t("lineitem"), "l_extendedprice", "l_returnflag", ["R"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


@query(
    "order_nulls",
    """SELECT c_custkey, coalesce(balance, -1) AS balance, CAST(place AS INTEGER) AS place FROM (
        SELECT *, row_number() OVER (ORDER BY balance DESC NULLS LAST, c_custkey) AS place FROM (
            SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS balance
            FROM customer))""",
)
def order_nulls(t):
    balance = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal")).cast("double")
    rows = t("customer").select("c_custkey", balance.alias("balance"))
    placed = global_ordinal(rows, [F.desc_nulls_last("balance"), F.col("c_custkey")], "place")
    return placed.select(
        "c_custkey", F.coalesce("balance", F.lit(-1.0)).alias("balance"), F.col("place").cast("int").alias("place")
    )


@query(
    "top_n",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice
    FROM orders ORDER BY CAST(o_totalprice AS DECIMAL(12,2)) DESC, o_orderkey LIMIT 20""",
)
def top_n(t):
    return (
        t("orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), F.asc("o_orderkey"))
        .limit(20)
    )


@query(
    "union_distinct",
    """SELECT c_nationkey AS nationkey, 'x' AS kind FROM customer
    UNION SELECT s_nationkey, 'x' FROM supplier""",
)
def union_distinct(t):
    left = t("customer").select(F.col("c_nationkey").alias("nationkey"), F.lit("x").alias("kind"))
    right = t("supplier").select(F.col("s_nationkey").alias("nationkey"), F.lit("x").alias("kind"))
    return left.union(right).distinct()


@query(
    "conform_union",
    with_(
        "craft_fact",
        "craft_customers",
        "craft_craftsmen",
        "craft_products",
        wide="""SELECT DISTINCT f.* EXCLUDE (load_dttm), c.* EXCLUDE (customer_id),
            m.* EXCLUDE (craftsman_id), p.* EXCLUDE (product_id)
            FROM craft_fact f JOIN craft_customers c ON f.customer_id = c.customer_id
            JOIN craft_craftsmen m ON f.craftsman_id = m.craftsman_id
            JOIN craft_products p ON f.product_id = p.product_id""",
    )
    + """SELECT order_status, product_type, craftsman_name, count(*) AS order_rows,
        CAST(sum(product_price) AS DOUBLE) AS money, min(customer_birthday) AS oldest,
        max(customer_email) AS last_email, min(product_description) AS first_product
    FROM wide GROUP BY ALL""",
)
def conform(t):
    landed = [(t.stored(df, f"source-{i}"), mapping) for i, (df, mapping) in enumerate(s.craft_sources(t))]
    united = conform_union(landed, distinct=True)
    return united.groupBy("order_status", "product_type", "craftsman_name").agg(
        F.count("*").alias("order_rows"),
        F.sum("product_price").alias("money"),
        F.min("customer_birthday").alias("oldest"),
        F.max("customer_email").alias("last_email"),
        F.min("product_description").alias("first_product"),
    )
