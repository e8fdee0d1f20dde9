"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from martkit.operators.load import upsert
from martkit.plans.queries.registry import query
from martkit.sources.documents import land_documents
from martkit.sources.files import read_csv_with_rejects, write_partitioned
from martkit.sources.views import register_views


@query(
    "csv_rejects",
    """SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'rejected' ELSE 'accepted' END AS outcome,
        user_id, count(*) AS n,
        CAST(sum(CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE event_id END) AS BIGINT) AS ids
    FROM events GROUP BY ALL""",
)
def csv_rejects(t):
    """Errors get a bad number, signups a surplus column; both must be set aside."""
    kind = F.col("event_type")
    line = F.concat_ws(
        ",",
        F.col("event_id").cast("string"),
        F.col("user_id").cast("string"),
        kind,
        F.when(kind == "error", "n/a").otherwise(F.col("value").cast("string")),
        F.when(kind == "signup", "surplus"),
    )
    path = t.scratch("csv")
    t("events").select(line).write.text(path)
    good, bad = read_csv_with_rejects(
        t.spark, path, "event_id bigint, user_id bigint, event_type string, value double", header=False
    )
    accepted = good.groupBy(F.lit("accepted").alias("outcome"), "user_id").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids")
    )
    user = F.split_part("_rejected_line", F.lit(","), F.lit(2)).cast("bigint")
    rejected = bad.groupBy(F.lit("rejected").alias("outcome"), user.alias("user_id")).agg(
        F.count("*").alias("n"), F.lit(0).cast("bigint").alias("ids")
    )
    return accepted.unionByName(rejected)


@query(
    "land_documents",
    """SELECT CAST(user_id AS VARCHAR) AS object_id, event_type, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1""",
)
def landed(t):
    rows = t("events").select("user_id", "event_id", "event_type", "ts")
    day = F.lit("2024-01-15").cast("timestamp_ntz")
    first = land_documents(rows.where(F.col("ts") < day), "user_id", "ts")
    second = land_documents(rows.where(F.col("ts") >= day), "user_id", "ts")
    stored = upsert(first, second, ["object_id"])
    doc = F.from_json("object_value", "event_id bigint, event_type string")
    return stored.select("object_id", doc.alias("d")).select("object_id", "d.*")


@query(
    "partitioned_sink",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""",
)
def partitioned_sink(t):
    """Write by month, write one year again, read back: the other months stay."""
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    orders = t("orders").withColumn("month", month)
    path = t.scratch("orders-by-month")
    write_partitioned(orders, path, ["month"])
    write_partitioned(orders.where(F.year("month") == 1997), path, ["month"])
    stored = t.spark.read.schema(orders.schema).parquet(path)
    return stored.groupBy("month").agg(
        F.count("*").alias("orders"), F.sum("o_totalprice").alias("total")
    )


_VIEW_SQL = """WITH spent AS (SELECT o_custkey, count(*) AS orders, max(o_orderdate) AS last_order
        FROM {orders} GROUP BY o_custkey)
    SELECT c_mktsegment, count(*) AS customers, sum(orders) AS orders,
        CAST(max(last_order) AS DATE) AS last_day
    FROM {customer} JOIN spent ON o_custkey = c_custkey GROUP BY c_mktsegment"""


@query(
    "sql_view",
    _VIEW_SQL.format(orders="orders", customer="customer").replace(
        "sum(orders)", "CAST(sum(orders) AS BIGINT)"
    ),
)
def sql_view(t):
    """SQL text over registered views."""
    register_views({"v_orders": t("orders"), "v_customer": t("customer")})
    return t.spark.sql(_VIEW_SQL.format(orders="v_orders", customer="v_customer"))
