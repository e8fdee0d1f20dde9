"""Join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.operators.load import resolve_keys, update_from
from martkit.operators.ordinals import assign_ids
from martkit.plans import standins as s
from martkit.plans.marts import inventory
from martkit.plans.queries.oracle import with_
from martkit.plans.queries.registry import query


@query(
    "join_inner_multi",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, n_name,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
    JOIN nation ON s_nationkey = n_nationkey""",
)
def join_inner_multi(t):
    lines = s.order_lines(t).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    home = (F.col("l_suppkey") == F.col("s_suppkey")) & (
        F.col("c_nationkey") == F.col("s_nationkey")
    )
    return (
        lines.join(t("supplier"), home)
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "n_name",
            F.col("l_extendedprice").alias("price"),
        )
    )


@query(
    "join_left",
    """SELECT o_orderkey, coalesce(n, 0) AS line_count FROM orders LEFT JOIN
        (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
)
def join_left(t):
    lines = t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return t("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.coalesce("n", F.lit(0)).alias("line_count")
    )


@query(
    "join_full",
    """SELECT coalesce(a.k, b.k) AS nationkey, coalesce(a.band, b.band) AS band,
        coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers
    FROM (SELECT c_nationkey AS k, CAST(floor(CAST(c_acctbal AS DECIMAL(12,2)) / 250) AS BIGINT) AS band,
              count(*) AS customers FROM customer GROUP BY 1, 2) a
    FULL JOIN (SELECT s_nationkey AS k, CAST(floor(CAST(s_acctbal AS DECIMAL(12,2)) / 250) AS BIGINT) AS band,
              count(*) AS suppliers FROM supplier GROUP BY 1, 2) b
        ON a.k = b.k AND a.band = b.band""",
)
def join_full(t):
    """All customers and suppliers by nation and balance; either side may lack a cell."""

    def cells(name, p, count):
        band = F.floor(F.col(f"{p}_acctbal") / 250).cast("bigint")
        keys = [F.col(f"{p}_nationkey").alias("nationkey"), band.alias("band")]
        return t(name).groupBy(*keys).agg(F.count("*").alias(count))

    joined = cells("customer", "c", "customers").join(cells("supplier", "s", "suppliers"), ["nationkey", "band"], "full")
    return joined.na.fill(0, ["customers", "suppliers"])


@query(
    "join_anti",
    """SELECT o_orderkey FROM orders WHERE NOT EXISTS
        (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def join_anti(t):
    returned = t("lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey")
    return (
        t("orders")
        .join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
        .select("o_orderkey")
    )


@query(
    "join_semi",
    """SELECT o_orderkey FROM orders WHERE o_orderkey IN
        (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 45)""",
)
def join_semi(t):
    large = t("lineitem").where(F.col("l_quantity") >= 45).select("l_orderkey")
    return (
        t("orders")
        .join(large, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .select("o_orderkey")
    )


@query(
    "join_json_key",
    with_("deliveries")
    + """SELECT d.order_id, md5(CAST(d.order_id AS VARCHAR)) AS delivery_id, d.courier_id, d.rate,
        CAST(d.tip_sum AS DOUBLE) AS tip_sum, o_orderstatus
    FROM deliveries d JOIN orders ON o_orderkey = d.order_id""",
)
def join_json_key(t):
    documents = s.deliveries(t).select(
        F.col("delivery_id").alias("object_id"),
        F.to_json(F.struct("delivery_id", "courier_id", "order_id", "rate", "tip_sum")).alias(
            "object_value"
        ),
    )
    schema = (
        "delivery_id string, courier_id bigint, order_id bigint, rate int, tip_sum decimal(14,2)"
    )
    shredded = documents.select(F.from_json("object_value", schema).alias("d")).select("d.*")
    return shredded.join(t("orders"), F.col("order_id") == F.col("o_orderkey")).select(
        "order_id", "delivery_id", "courier_id", "rate", "tip_sum", "o_orderstatus"
    )


@query(
    "calendar_join",
    """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id,
        CAST(isodow(o_orderdate) > 5 AS BOOLEAN) AS weekend,
        CAST(date_trunc('week', o_orderdate) AS DATE) AS first_day_of_week,
        CAST(week(o_orderdate) AS INTEGER) AS week_of_year, count(*) AS orders
    FROM orders GROUP BY ALL""",
)
def calendar_join(t):
    per_day = t("orders").groupBy(F.to_date("o_orderdate").alias("date_actual")).agg(
        F.count("*").alias("orders")
    )
    return per_day.join(s.calendar_of(per_day, "date_actual"), "date_actual", "left").select(
        "date_id", "weekend", "first_day_of_week", "week_of_year", "orders"
    )


@query(
    "update_from",
    """SELECT c_custkey, coalesce(m, c_mktsegment) AS c_mktsegment,
        CAST(coalesce(spent, CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS c_acctbal
    FROM customer LEFT JOIN (SELECT o_custkey, 'ACTIVE' AS m,
        max(CAST(o_totalprice AS DECIMAL(12,2))) AS spent FROM orders
        WHERE o_orderdate >= DATE '2001-01-01' GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def update_customers(t):
    recent = t("orders").where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    updates = recent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal"), F.lit("ACTIVE").alias("c_mktsegment")
    )
    return update_from(t("customer"), updates, ["c_custkey"], ["c_mktsegment", "c_acctbal"]).select(
        "c_custkey", "c_mktsegment", "c_acctbal"
    )


@query(
    "resolve_keys",
    """WITH brands AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS brand_id
            FROM (SELECT DISTINCT p_brand FROM part)),
        kinds AS (SELECT p_type, row_number() OVER (ORDER BY p_type) AS kind_id
            FROM (SELECT DISTINCT p_type FROM part))
    SELECT p_partkey, brand_id, kind_id FROM part JOIN brands USING (p_brand) JOIN kinds USING (p_type)""",
)
def resolve(t):
    part = t("part")
    brands = assign_ids(part.select("p_brand").distinct(), None, "brand_id", ["p_brand"])
    kinds = assign_ids(part.select("p_type").distinct(), None, "kind_id", ["p_type"])
    return resolve_keys(
        part.select("p_partkey", "p_brand", "p_type"),
        [(brands, {"p_brand": "p_brand"}, "brand_id"), (kinds, {"p_type": "p_type"}, "kind_id")],
    ).select("p_partkey", "brand_id", "kind_id")


_SOLD = with_(
    "cars",
    "car_sales",
    sold="""SELECT l_partkey, max(sales_date) AS sales_date,
        arg_max(cost, sales_date) AS cost FROM car_sales GROUP BY l_partkey""",
)


@query(
    "entity_detail",
    _SOLD
    + """SELECT vin, noun AS car_model_name, p_brand AS car_model_brand,
        CAST(price AS DOUBLE) AS price, date_start,
        CASE WHEN s.l_partkey IS NOT NULL THEN 'sold' ELSE status END AS status,
        sales_date, CAST(cost AS DOUBLE) AS sales_cost
    FROM cars LEFT JOIN sold s ON l_partkey = p_partkey""",
)
def entity_detail(t):
    sales = s.car_sales(t)
    cars = inventory.apply_sales(s.cars(t), sales)
    return inventory.car_detail(cars, s.car_models(t), sales)
