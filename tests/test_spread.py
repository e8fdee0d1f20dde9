from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martkit import session
from martkit.operators import load
from martkit.plans import standins
from martkit.plans.marts.customer_report import customer_report
from tests.conftest import plan_of, tuples


@pytest.fixture
def stored(spark, tmp_path):
    """Lookup of stored lines, orders and the dimensions of the craft marts."""
    n = 600
    id_of = lambda size: (F.col("id") % size)
    frames = {
        "lineitem": spark.range(n).select(
            id_of(150).alias("l_orderkey"), id_of(20).alias("l_partkey"), id_of(5).alias("l_suppkey"),
            F.lit("A").alias("l_returnflag"), F.to_timestamp_ntz(F.lit("1998-01-09 00:00:00")).alias("l_shipdate"),
            (F.col("id") % 7 + 1).cast("decimal(12,2)").alias("l_extendedprice"),
        ),
        "orders": spark.range(150).select(
            F.col("id").alias("o_orderkey"), id_of(10).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00")).alias("o_orderdate"),
        ),
        "customer": spark.range(10).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c#"), F.col("id").cast("string")).alias("c_name")),
        "supplier": spark.range(5).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("s#"), F.col("id").cast("string")).alias("s_name")),
        "part": spark.range(20).select(
            F.col("id").alias("p_partkey"), F.lit("large ring").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
            F.lit("LARGE").alias("p_type"), F.lit(1).cast("decimal(12,2)").alias("p_retailprice"),
        ),
    }
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
    return lambda name: spark.read.parquet(str(tmp_path / name))


def test_lines_get_more_partitions_with_more_input(stored, monkeypatch):
    """Without this a task holds 64 MB of compressed rows, many times as much in memory."""
    before = tuples(standins.venue_sales(stored))
    assert "REPARTITION_BY_NUM" not in plan_of(standins.venue_sales(stored))
    monkeypatch.setattr(session, "SPREAD_BYTES", 64)
    lines = stored("lineitem")
    few = session.spread(lines, "l_orderkey").rdd.getNumPartitions()
    assert few > 4
    monkeypatch.setattr(session, "SPREAD_BYTES", 32)
    assert session.spread(lines, "l_orderkey").rdd.getNumPartitions() >= 2 * few
    sales = standins.venue_sales(stored)
    assert "REPARTITION_BY_NUM" in plan_of(sales)
    assert tuples(sales) == before


def test_frames_without_files_stay_as_they_are(spark):
    df = spark.createDataFrame([(1,)], "k int")
    assert session.spread(df, "k") is df


def test_conformed_rows_meet_before_they_are_compared(stored, monkeypatch):
    """Without this each map task holds all wide rows of its input split."""
    sources = standins.craft_sources(stored)
    before = tuples(load.conform_union(sources))
    assert len(before) == len(set(before))
    monkeypatch.setattr(session, "SPREAD_BYTES", 64)
    united = load.conform_union(standins.craft_sources(stored))
    assert "REPARTITION_BY_NUM" in plan_of(united).split("Union")[0]
    assert tuples(united) == before


def test_customer_report_is_dealt_by_customer(spark, stored, tmp_path, monkeypatch):
    """Without this the last joins and windows of all customers meet in merged partitions."""
    standins.craft_fact(stored).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    report = lambda: customer_report(fact, standins.craft_customers(stored), standins.craft_products(stored))
    before = tuples(report())
    assert before and "REPARTITION_BY_NUM" not in plan_of(report())
    monkeypatch.setattr(session, "SPREAD_BYTES", 64)
    assert plan_of(report()).count("REPARTITION_BY_NUM") >= 4
    assert tuples(report()) == before


def test_large_merges_meet_in_dealt_partitions(spark, tmp_path, monkeypatch):
    """Without this both sides of a merge meet in merged partitions; null and repeated keys count as before."""
    rows = [(None, 1, "n"), (None, 1, "o"), ("a", None, "x"), ("a", None, "x"), ("b", 2, "y"), ("c", 3, "z")]
    spark.createDataFrame(rows, "k string, l int, v string").write.parquet(str(tmp_path / "new"))
    spark.createDataFrame([(7, None, 1, "old"), (8, "b", 2, "old"), (9, "d", 4, "old")], "sk bigint, k string, l int, v string").withColumn(
        "load_dttm", F.lit("2020-01-01").cast("timestamp")
    ).write.parquet(str(tmp_path / "now"))
    new, now = (spark.read.parquet(str(tmp_path / n)) for n in ("new", "now"))
    merged = lambda: load.merge_dim(now, new, ["k", "l"], ["v"], F.lit("2024-01-01").cast("timestamp"), "sk")
    keyed = lambda how: load.resolve_keys(new, [(now, {"k": "k", "l": "l"}, "sk")], how)
    before = [tuples(merged()), tuples(keyed("left")), tuples(keyed("inner"))]
    assert len(before[0]) == 5 and len(before[1]) == 6 and len(before[2]) == 3
    assert "REPARTITION_BY_NUM" not in plan_of(merged())
    monkeypatch.setattr(session, "SPREAD_BYTES", 64)
    assert "REPARTITION_BY_NUM" in plan_of(merged()) and "REPARTITION_BY_NUM" in plan_of(keyed("left"))
    assert [tuples(merged()), tuples(keyed("left")), tuples(keyed("inner"))] == before
    wide = now.withColumn("l", F.col("l").cast("bigint"))  # no common hash
    assert tuples(load.resolve_keys(new, [(wide, {"k": "k", "l": "l"}, "sk")], "inner"), "sk") == [(7,), (7,), (8,)]


def test_tables_of_many_rows_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Without this Spark sends a table through the driver whose files are small, however many rows they hold."""
    monkeypatch.setattr(session, "COUNT_BYTES", 0, raising=False)
    rows = spark.range(300_000).select("id", F.lit("same").alias("k"), (F.col("id") % 3).alias("l"))
    for name, df in (("many", rows), ("few", rows.where("id < 5"))):
        df.write.parquet(str(tmp_path / name))
    many, few = (spark.read.parquet(str(tmp_path / n)) for n in ("many", "few"))
    fact = spark.createDataFrame([("same", 1), ("same", None), ("other", 2)], "k string, l bigint")
    keyed = lambda dim: load.resolve_keys(fact, [(dim, {"k": "k", "l": "l"}, "id")])
    assert "SortMergeJoin" in plan_of(keyed(many)) and "Broadcast" not in plan_of(keyed(many))
    assert "BroadcastHashJoin" in plan_of(keyed(few))
    assert tuples(keyed(many)) == tuples(keyed(few)) == [("other", 2, None), ("same", 1, 1), ("same", None, None)]
