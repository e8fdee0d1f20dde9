"""Loaders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from martkit.operators.load import (
    changed_keys,
    dim_increment,
    insert_missing,
    merge_dim,
    rekey,
    replace_by_key,
    replace_slice,
    upsert,
)
from martkit.operators.select import latest_per_key
from martkit.plans import standins as s
from martkit.plans.marts import dealership, inventory, venues
from martkit.plans.queries.oracle import with_
from martkit.plans.queries.registry import query

_SPLIT = "1999-01-01"


def _orders_by_customer(t, newer: bool):
    """(customer, order, day, price) rows of orders before or from the split day."""
    day = F.to_date("o_orderdate")
    limit = F.lit(_SPLIT).cast("date")
    rows = t("orders").where(day >= limit if newer else day < limit)
    return rows.select("o_custkey", "o_orderkey", day.alias("day"), "o_totalprice")


def _latest_of(t, newer: bool):
    return latest_per_key(_orders_by_customer(t, newer), ["o_custkey"], ["day", "o_orderkey"])


_LATEST = f"""WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day,
        CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
        o_orderdate >= DATE '{_SPLIT}' AS newer FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, newer
        ORDER BY day DESC, o_orderkey DESC) AS rn FROM o),
    cur AS (SELECT * FROM r WHERE rn = 1 AND NOT newer), inc AS (SELECT * FROM r WHERE rn = 1 AND newer)
    """


@query(
    "merge_dim",
    _LATEST
    + """SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, stamp FROM (
        SELECT *, '2020-01-02 00:00:00' AS stamp FROM inc
        UNION ALL SELECT *, '2020-01-01 00:00:00' FROM cur
            WHERE o_custkey NOT IN (SELECT o_custkey FROM inc))""",
)
def merge(t):
    current = _latest_of(t, newer=False).withColumn(
        "load_dttm", F.lit(datetime(2020, 1, 1)).cast("timestamp")
    )
    merged = merge_dim(
        current,
        _orders_by_customer(t, newer=True),
        ["o_custkey"],
        ["day", "o_orderkey", "o_totalprice"],
        datetime(2020, 1, 2),
        order_by=["day", "o_orderkey"],
    )
    return merged.select("o_custkey", "o_orderkey", "o_totalprice", F.col("load_dttm").alias("stamp"))


@query(
    "insert_missing",
    _LATEST
    + """SELECT o_custkey, o_orderkey FROM cur UNION ALL
        SELECT o_custkey, o_orderkey FROM inc WHERE o_custkey NOT IN (SELECT o_custkey FROM cur)""",
)
def insert_new(t):
    return insert_missing(
        _latest_of(t, newer=False), _orders_by_customer(t, newer=True), ["o_custkey"],
        ["day", "o_orderkey"],
    ).select("o_custkey", "o_orderkey")


@query(
    "upsert",
    _LATEST
    + """SELECT o_custkey, o_orderkey, day FROM inc UNION ALL
        SELECT o_custkey, o_orderkey, day FROM cur WHERE o_custkey NOT IN (SELECT o_custkey FROM inc)""",
)
def upsert_latest(t):
    return upsert(
        _latest_of(t, newer=False), _orders_by_customer(t, newer=True), ["o_custkey"],
        ["day", "o_orderkey"],
    ).select("o_custkey", "o_orderkey", "day")


@query(
    "replace_by_key",
    _LATEST
    + """SELECT o_custkey, o_orderkey FROM o WHERE newer UNION ALL
        SELECT o_custkey, o_orderkey FROM o WHERE NOT newer
            AND o_custkey NOT IN (SELECT o_custkey FROM o WHERE newer)""",
)
def replace_customers(t):
    return replace_by_key(
        _orders_by_customer(t, newer=False), _orders_by_customer(t, newer=True), ["o_custkey"]
    ).select("o_custkey", "o_orderkey")


@query(
    "replace_slice",
    """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n,
        CAST(sum(CASE WHEN o_orderdate >= DATE '2000-01-01' THEN 2 ELSE 1 END
            * CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""",
)
def replace_days(t):
    rows = t("orders").select(
        F.to_date("o_orderdate").alias("day"),
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(14,2)").alias("price"),
    )
    rerun = rows.where(F.col("day") >= F.lit("2000-01-01").cast("date")).withColumn(
        "price", (F.col("price") * 2).cast("decimal(14,2)")
    )
    once = replace_slice(rows, rerun, "day")
    twice = replace_slice(once, rerun, "day")
    return twice.groupBy("day").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


@query(
    "changed_keys",
    """SELECT DISTINCT o_custkey AS customer_id FROM orders WHERE o_orderdate > DATE '2001-07-01'
    UNION SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        JOIN part ON p_partkey = l_partkey WHERE p_size = 50""",
)
def changed(t):
    fact = s.craft_fact(t)
    moved = F.when(F.col("p_size") == 50, F.lit("2001-12-31")).otherwise(F.lit("1995-01-01"))
    products = t("part").select(
        F.col("p_partkey").alias("product_id"), moved.cast("timestamp_ntz").alias("load_dttm")
    )
    # customers without any line count as changed through their orders
    orders = t("orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.lit(None).cast("bigint").alias("product_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("load_dttm"),
    )
    both = fact.select("customer_id", "product_id", "load_dttm").unionByName(orders)
    return changed_keys(
        both,
        "customer_id",
        [(s.craft_customers(t), "customer_id"), (products, "product_id")],
        F.lit("2001-07-01").cast("timestamp_ntz"),
    )


@query(
    "dim_increment",
    with_("order_log")
    + """SELECT customer_id, first_name, last_name, city_id FROM (
        SELECT customer_id, first_name, last_name, city_id, row_number() OVER (
            PARTITION BY customer_id ORDER BY day DESC, city_id DESC) AS rn FROM order_log)
    WHERE rn = 1""",
)
def dim_customers(t):
    log = t.stored(s.user_order_log(t), "order-log")
    cols = ["first_name", "last_name", "city_id"]
    early = log.where(F.col("date_time") < F.lit(_SPLIT).cast("timestamp_ntz"))
    empty = log.select("customer_id", *cols).limit(0)
    first = t.stored(
        dim_increment(empty, early, "customer_id", cols, ["date_time", "city_id"]), "d-customer"
    )
    return dim_increment(first, log, "customer_id", cols, ["date_time", "city_id"])


def _raw_cars(t):
    """The raw table as stored: every dimension scans only its own columns."""
    return t.stored(s.raw_car_sales(t), "raw-car-sales")


@query(
    "decompose",
    with_("car_sales_raw")
    + """SELECT brand, brand_origin, model, colour, count(*) AS sales,
        CAST(sum(price) AS DOUBLE) AS revenue, count(DISTINCT person_name) AS clients
    FROM car_sales_raw GROUP BY ALL""",
)
def decomposed(t):
    """The split table joined together again through its surrogate keys."""
    dims, fact = dealership.normalise(_raw_cars(t))
    return (
        fact.join(dims["models"], "model_id")
        .join(dims["brands"], "brand_id")
        .join(dims["origins"], "origin_id")
        .join(dims["colours"], "colour_id")
        .join(dims["clients"], "client_id")
        .groupBy("brand", "brand_origin", "model", "colour")
        .agg(
            F.count("*").alias("sales"),
            F.sum("price").alias("revenue"),
            F.count_distinct("person_name").alias("clients"),
        )
    )


@query(
    "decompose_dims",
    with_("car_sales_raw")
    + """SELECT 'brands' AS dim, count(*) AS n, count(*) AS max_id FROM
            (SELECT DISTINCT brand, brand_origin FROM car_sales_raw)
    UNION ALL SELECT 'clients', count(*), count(*) FROM
            (SELECT DISTINCT person_name, phone FROM car_sales_raw)
    UNION ALL SELECT 'colours', count(*), count(*) FROM (SELECT DISTINCT colour FROM car_sales_raw)
    UNION ALL SELECT 'models', count(*), count(*) FROM
            (SELECT DISTINCT model, gasoline_consumption, brand, brand_origin FROM car_sales_raw)
    UNION ALL SELECT 'origins', count(*), count(*) FROM
            (SELECT DISTINCT brand_origin FROM car_sales_raw)""",
)
def dims_of_cars(t):
    dims, _ = dealership.normalise(_raw_cars(t))
    keys = {d.name: d.sk for d in dealership.DIMS}
    counts = [
        df.agg(F.lit(name).alias("dim"), F.count("*").alias("n"), F.max(keys[name]).alias("max_id"))
        for name, df in dims.items()
    ]
    united = counts[0]
    for more in counts[1:]:
        united = united.unionByName(more)
    return united


@query(
    "phone_migration",
    """SELECT c_name AS manager, '8-800-2500-' || (99 + row_number() OVER (ORDER BY c_name))
        || '|8-9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phones FROM customer""",
)
def phones(t):
    return venues.phone_migration(s.managers(t))


@query(
    "apply_status",
    with_("cars")
    + """SELECT vin, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem) THEN 'sold'
        ELSE status END AS status FROM cars""",
)
def sell(t):
    return inventory.apply_sales(s.cars(t), s.car_sales(t)).select("vin", "status")


_REVERTED = "sales_date >= DATE '2000-01-01'"


@query(
    "revert_status",
    with_("cars", "car_sales")
    + f"""SELECT vin, CASE WHEN p_partkey IN (SELECT l_partkey FROM car_sales WHERE {_REVERTED})
            THEN 'available' WHEN p_partkey IN (SELECT l_partkey FROM car_sales) THEN 'sold'
            ELSE status END AS status,
        (SELECT count(*) FROM car_sales WHERE NOT ({_REVERTED}) AND l_partkey = p_partkey) AS sales_left
    FROM cars""",
)
def revert(t):
    sales = s.car_sales(t)
    undone = sales.where(F.col("sales_date") >= F.lit("2000-01-01").cast("date"))
    cars, rest = inventory.revert_sales(
        inventory.apply_sales(s.cars(t), sales), sales, undone.select("sales_number")
    )
    left = rest.groupBy(F.col("car_vin").alias("vin")).agg(F.count("*").alias("sales_left"))
    return cars.join(left, "vin", "left").select(
        "vin", "status", F.coalesce("sales_left", F.lit(0)).alias("sales_left")
    )


@query(
    "rekey",
    with_("cars")
    + """SELECT CASE WHEN p_partkey % 2 = 0 THEN replace(vin, 'VIN', 'NEW') ELSE vin END AS vin,
        count(l_partkey) AS sale_lines
    FROM cars LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL""",
)
def renamed(t):
    cars = s.cars(t)
    lines = t("lineitem").select(
        F.concat(F.lit("VIN"), F.lpad(F.col("l_partkey").cast("string"), 12, "0")).alias("car_vin")
    )
    mapping = t("part").where(F.col("p_partkey") % 2 == 0).select(
        F.concat(F.lit("VIN"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("old"),
        F.concat(F.lit("NEW"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("new"),
    )
    new_cars, new_lines = rekey([(cars, "vin"), (lines, "car_vin")], mapping)
    sold = new_lines.groupBy(F.col("car_vin").alias("vin")).agg(F.count("*").alias("sale_lines"))
    return new_cars.join(sold, "vin", "left").select(
        "vin", F.coalesce("sale_lines", F.lit(0)).alias("sale_lines")
    )


@query(
    "tenure_spans",
    """SELECT l_suppkey AS venue_id, o_custkey % 50 AS manager,
        CAST(min(o_orderdate) AS DATE) AS start_date, CAST(max(o_orderdate) AS DATE) AS end_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def spans(t):
    return venues.tenure_spans(s.venue_work_days(t))
