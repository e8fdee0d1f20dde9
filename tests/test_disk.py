"""What stays on disk behind stored tables, and how wide rows travel to them."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from martkit.operators.vault import store_stage
from martkit.plans import standins
from martkit.plans.queries.registry import REGISTRY, Tables
from martkit.sources.files import refresh_table
from tests.conftest import plan_of, tuples


def _shuffle_files(spark) -> int:
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").count("shuffle_")


def test_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    """Without this they stay until the driver collects its garbage, beside the rows that were written."""
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    texts = df.select(F.to_json(F.struct(F.col("k").alias("id"))).alias("payload"))
    before = _shuffle_files(spark)
    table = refresh_table(df, str(tmp_path / "table"))
    stage = store_stage(texts, str(tmp_path / "stage"))
    assert _shuffle_files(spark) <= before
    assert table.count() == stage["orders"].count() == 7


def _tables(spark):
    frames = {
        "lineitem": ([(1, 1, 5, 2.0), (1, 1, 4, 3.0), (1, 2, 6, 1.0), (1, 9, 3, 1.0), (2, 2, 7, 1.0), (3, 9, 4, 1.0), (None, 1, 4, 1.0), (4, None, 4, 1.0)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double"),
        "part": ([(1, "a", "A", 1.0), (2, "b", "B", 2.0), (2, "b", "B", 2.0), (None, "c", "C", 3.0)], "p_partkey bigint, p_name string, p_type string, p_retailprice double"),
        "supplier": ([(3, "s3"), (4, "s4"), (4, "s4"), (5, "s5"), (6, "s6")], "s_suppkey bigint, s_name string"),
        "customer": ([(1, "c1")], "c_custkey bigint, c_name string"),
        "orders": ([(k, 1, "F", 1.0) for k in (1, 2, 3, 4)], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"),
    }
    made = {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in frames.items()}
    made["orders"] = made["orders"].withColumn("o_orderdate", F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00")))
    return made.__getitem__


def test_baskets_are_not_shuffled_for_names(spark, monkeypatch):
    """Without this whole baskets travel by customer and by supplier; an order's supplier is the least of its known products."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents = standins.order_documents(_tables(spark))
        top = next(line for line in plan_of(documents).splitlines() if "Join" in line)
        assert "l_orderkey" in top and "custkey" not in top and "supp" not in top
        got = tuples(documents)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # order 1: supplier 3 sold no known part, supplier 4 is known twice; order 2: its supplier is unknown
    assert [i for i, _ in got] == [1, 1]
    read = json.loads(got[0][1])
    assert read["restaurant"] == {"id": "4", "name": "s4"} and got[0] == got[1]
    assert [(p["id"], p["quantity"]) for p in read["products"]] == [("1", 5), ("2", 1), ("2", 1)]


def test_sources_and_messages_are_stored_once(spark, monkeypatch):
    """Without this the joins and baskets behind them stay on disk beside the shuffle of their rows."""
    names, scratch = [], Tables.scratch
    monkeypatch.setattr(Tables, "scratch", lambda self, name: names.append(name) or scratch(self, name))
    for query in ("conform_union", "vault_replay"):
        REGISTRY[query].run(Tables(spark, "/root/testdata/sf0.001"))
    assert [n for n in names if n.startswith("source-")] == [f"source-{i}" for i in range(4)] and names.count("messages") == 1
