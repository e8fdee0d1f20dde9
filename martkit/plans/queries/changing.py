"""Stored tables that batches change in part: event logs, day slices, key buckets, incremental runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.hashing import md5_key
from martkit.operators.vault import changes_of_log, latest_of_log, log_events
from martkit.plans.queries.registry import query
from martkit.sources.runs import read_mart, run_increment
from martkit.sources.slices import overwrite_slices, read_buckets, read_table, upsert_buckets

_LOADED = datetime(2024, 1, 1)


def _event_log(t):
    """Events of all users, loaded in four batches that arrive out of order; one of them twice."""
    path = t.scratch("event-log")
    stage = t("events").withColumn("hk_user", md5_key("user_id"))
    late = F.col("event_id") % 3 == 0
    mid = F.lit("2024-01-15").cast("timestamp_ntz")
    batches = {"b1": (F.col("ts") >= mid) & ~late, "b2": (F.col("ts") < mid) & ~late, "b3": (F.col("ts") >= mid) & late, "b4": (F.col("ts") < mid) & late}
    for token in ("b1", "b2", "b3", "b4", "b2"):
        log_events(stage.where(batches[token]), path, token, "hk_user", ["event_type"], ["ts", "event_id"], _LOADED, "s3")
    return t.spark.read.parquet(path)


@query(
    "satellite_event_log",
    """SELECT md5(CAST(user_id AS VARCHAR)) AS hk_user, event_type, event_id,
        CASE WHEN event_id % 3 <> 0 THEN CASE WHEN ts >= '2024-01-15' THEN 'b1' ELSE 'b2' END
             ELSE CASE WHEN ts >= '2024-01-15' THEN 'b3' ELSE 'b4' END END AS load_token
    FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
    WHERE previous IS NULL OR previous <> event_type""",
)
def satellite_event_log(t):
    """Changes read from the whole log, whatever the batches were."""
    return changes_of_log(_event_log(t), "hk_user", ["ts", "event_id"]).select("hk_user", "event_type", "event_id", "load_token")


@query(
    "satellite_log_latest",
    """SELECT md5(CAST(user_id AS VARCHAR)) AS hk_user, event_type, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def satellite_log_latest(t):
    return latest_of_log(_event_log(t), "hk_user", ["ts", "event_id"]).select("hk_user", "event_type", "event_id")


_DAILY = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("users", T.LongType()),
        T.StructField("day", T.DateType()),
    ]
)


@query(
    "rerun_day",
    """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events
    WHERE CAST(ts AS DATE) <> DATE '2024-01-12' AND NOT (CAST(ts AS DATE) = DATE '2024-01-11' AND event_type = 'error')
    GROUP BY 1, 2""",
)
def rerun_day(t):
    """Days run again with corrected rows replace their slices; one day loses all its rows."""
    path = t.scratch("daily")
    day = F.to_date("ts")
    daily = lambda rows: rows.groupBy(day.alias("day"), "event_type").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users")
    )
    events = t("events")
    overwrite_slices(daily(events), path, "day")
    at = lambda d: day == F.lit(d).cast("date")
    for _ in range(2):
        overwrite_slices(daily(events.where(at("2024-01-11") & (F.col("event_type") != "error"))), path, "day", ["2024-01-11", "2024-01-12"])
    return read_table(t.spark, path, _DAILY).select("day", "event_type", "n", "users")


_LAST_ORDER = T.StructType(
    [
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("day", T.DateType()),
    ]
)


@query(
    "upsert_buckets",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1""",
)
def upsert_in_buckets(t):
    """Last order of every customer: all orders up to a day first, then the small batch of the days since."""
    path = t.scratch("last-order")
    rows = t("orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    split = F.lit("2001-07-10").cast("date")
    for batch in (rows.where(F.col("day") < split), rows.where(F.col("day") >= split)):
        upsert_buckets(t.spark, path, _LAST_ORDER, batch, ["o_custkey"], ["day", "o_orderkey"], buckets=64)
    return read_buckets(t.spark, path, _LAST_ORDER)


_TOTALS = T.StructType(
    [
        T.StructField("o_custkey", T.LongType()),
        T.StructField("orders", T.LongType()),
        T.StructField("total", T.DecimalType(22, 2)),
    ]
)


@query(
    "watermark_runs",
    """SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM orders GROUP BY 1""",
)
def watermark_runs(t):
    """Totals per customer in three runs; the second dies after its rows are written and is run again."""
    base = t.scratch("totals")
    orders = t("orders")

    def run(until: str) -> None:
        seen = orders.where(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))

        def touched(since):
            keys = seen.where(F.col("o_orderdate") > since).select("o_custkey").distinct()
            return seen.join(keys, "o_custkey", "left_semi").groupBy("o_custkey").agg(
                F.count("*").alias("orders"), F.sum("o_totalprice").alias("total")
            )

        run_increment(t.spark, base, seen, "o_orderdate", touched)

    run("1997-01-01")
    # What a run leaves that dies before it commits: files without their mark.
    torn = read_mart(t.spark, base, _TOTALS, ["o_custkey"]).withColumn("loaded_to", F.lit("2001-01-01").cast("timestamp_ntz"))
    torn.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/run=2")
    run("1999-06-01")
    run("9999-01-01")
    return read_mart(t.spark, base, _TOTALS, ["o_custkey"])
