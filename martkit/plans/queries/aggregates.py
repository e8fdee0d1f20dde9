"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.operators.quality import null_share
from martkit.operators.quantiles import exact_median
from martkit.operators.select import count_by_value, ordered_list
from martkit.plans import standins as s
from martkit.plans.marts import dealership
from martkit.plans.queries.oracle import with_
from martkit.plans.queries.registry import query


@query(
    "agg_basic",
    """SELECT l_returnflag, l_linestatus, count(*) AS n,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mean,
        CAST(min(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS lowest,
        CAST(max(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS highest
    FROM lineitem GROUP BY ALL""",
)
def agg_basic(t):
    price = F.col("l_extendedprice")
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.sum(price).alias("total"),
        (F.sum(price).cast("double") / F.count("*")).alias("mean"),
        F.min(price).alias("lowest"),
        F.max(price).alias("highest"),
    )


@query(
    "agg_distinct",
    """SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts
    FROM lineitem GROUP BY l_suppkey""",
)
def agg_distinct(t):
    # one distinct count per aggregate: two in one would expand every row twice
    lines = t("lineitem")
    orders = lines.groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("orders"))
    parts = lines.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"))
    return orders.join(parts, "l_suppkey")


@query(
    "status_counts",
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks,
        count(*) FILTER (WHERE event_type = 'view') AS views,
        count(*) FILTER (WHERE event_type = 'signup') AS signups FROM events GROUP BY user_id""",
)
def status_counts(t):
    return count_by_value(
        t("events"),
        ["user_id"],
        "event_type",
        {"clicks": "click", "views": "view", "signups": "signup"},
    )


@query(
    "agg_cond_distinct",
    """SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END)
        AS returned_orders FROM lineitem GROUP BY l_suppkey""",
)
def agg_cond_distinct(t):
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))
    return t("lineitem").groupBy("l_suppkey").agg(
        F.count_distinct(returned).alias("returned_orders")
    )


@query(
    "agg_median",
    """SELECT l_suppkey, median(l_quantity) AS median_quantity,
        median(date_diff('day', o_orderdate, l_shipdate)) AS median_days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_suppkey""",
)
def agg_median(t):
    return s.order_lines(t).groupBy("l_suppkey").agg(
        F.median("l_quantity").alias("median_quantity"),
        F.median(F.datediff("l_shipdate", "o_orderdate")).alias("median_days"),
    )


@query(
    "agg_string",
    """SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types
    FROM part GROUP BY p_brand""",
)
def agg_string(t):
    kinds = t("part").select("p_brand", "p_type").distinct()
    return kinds.groupBy("p_brand").agg(
        F.expr("listagg(p_type, ', ') WITHIN GROUP (ORDER BY p_type)").alias("types")
    )


@query(
    "ordered_list",
    """SELECT o_custkey, string_agg(o_orderpriority, '|' ORDER BY o_orderdate, o_orderkey)
        AS priorities FROM orders GROUP BY o_custkey""",
)
def ordered(t):
    order = F.struct("o_orderdate", "o_orderkey")
    return t("orders").groupBy("o_custkey").agg(
        ordered_list(order, F.col("o_orderpriority")).alias("priorities")
    )


@query(
    "agg_first_last",
    """SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type,
        arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id""",
)
def agg_first_last(t):
    order = F.struct("ts", "event_id")
    return t("events").groupBy("user_id").agg(
        F.min_by("event_type", order).alias("first_type"),
        F.max_by("event_type", order).alias("last_type"),
    )


@query(
    "agg_having",
    """SELECT o_custkey, count(DISTINCT o_orderkey) AS orders FROM orders
    GROUP BY o_custkey HAVING count(DISTINCT o_orderkey) > 10""",
)
def agg_having(t):
    return (
        t("orders")
        .groupBy("o_custkey")
        .agg(F.count_distinct("o_orderkey").alias("orders"))
        .where(F.col("orders") > 10)
    )


@query(
    "agg_by_month",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL""",
)
def agg_by_month(t):
    return t("orders").groupBy(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.sum("o_totalprice").alias("total"))


_MODELS = with_(
    "car_sales_raw",
    models="""SELECT DISTINCT brand, model, gasoline_consumption, brand_origin FROM car_sales_raw""",
)


@query(
    "null_share",
    _MODELS
    + """SELECT count(*) AS total_rows, count(*) FILTER (WHERE gasoline_consumption IS NULL
            OR gasoline_consumption = 'null') AS missing_rows,
        100.0::DOUBLE * count(*) FILTER (WHERE gasoline_consumption IS NULL
            OR gasoline_consumption = 'null') / count(*) AS missing_percent FROM models""",
)
def missing_share(t):
    models = dealership.parse_auto(s.raw_car_sales(t)).select(
        "brand", "model", "gasoline_consumption", "brand_origin"
    )
    return null_share(models.distinct(), "gasoline_consumption", dealership.MISSING)


@query(
    "agg_span",
    """SELECT l_suppkey, o_custkey % 50 AS manager, CAST(min(o_orderdate) AS DATE) AS first_day,
        CAST(max(o_orderdate) AS DATE) AS last_day
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def agg_span(t):
    return s.order_lines(t).groupBy("l_suppkey", (F.col("o_custkey") % 50).alias("manager")).agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"),
        F.to_date(F.max("o_orderdate")).alias("last_day"),
    )


@query(
    "median_hot_group",
    """SELECT 'all' AS part, CAST(median(CAST(l_extendedprice AS DECIMAL(12,2))::DECIMAL(16,4)) AS DOUBLE) AS price FROM lineitem
    UNION ALL SELECT l_returnflag, CAST(median(CAST(l_extendedprice AS DECIMAL(12,2))::DECIMAL(16,4)) AS DOUBLE) FROM lineitem GROUP BY 1""",
)
def median_hot_group(t):
    """A group of all rows and three large ones, without a group's values in one task."""
    rows = t("lineitem").select(F.explode(F.array(F.lit("all"), "l_returnflag")).alias("part"), "l_extendedprice")
    return exact_median(rows, ["part"], "l_extendedprice", "price")
