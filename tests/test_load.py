from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martkit.operators.decompose import DimSpec, FactSpec, decompose
from martkit.operators.load import (
    apply_status,
    changed_keys,
    conform_union,
    dim_increment,
    insert_missing,
    merge_dim,
    rekey,
    replace_by_key,
    replace_slice,
    resolve_keys,
    revert_status,
    update_from,
    upsert,
)
from martkit.sources.files import (
    read_csv,
    read_csv_with_rejects,
    read_rows,
    refresh_table,
    write_partitioned,
)
from martkit.sources.database import day_predicates
from martkit.sources.documents import land_documents
from martkit.sources.store import TableStore
from tests.conftest import plan_of, tuples

ROW = "k string, v int, t int"


@pytest.fixture
def current(spark):
    return spark.createDataFrame([("a", 1, 1), ("b", 2, 1), (None, 0, 1)], ROW)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([("b", 9, 2), ("b", 8, 3), ("c", 3, 2), (None, 7, 2)], ROW)


def test_insert_missing(current, batch):
    once = insert_missing(current, batch, ["k"], ["t"])
    assert tuples(once) == [("a", 1, 1), ("b", 2, 1), ("c", 3, 2), (None, 0, 1)]
    assert tuples(insert_missing(once, batch, ["k"], ["t"])) == tuples(once)


def test_order_of_insert_batches_is_irrelevant(spark, current):
    one = spark.createDataFrame([("x", 1, 1)], ROW)
    two = spark.createDataFrame([("y", 2, 2)], ROW)
    ab = insert_missing(insert_missing(current, one, ["k"]), two, ["k"])
    ba = insert_missing(insert_missing(current, two, ["k"]), one, ["k"])
    assert tuples(ab) == tuples(ba)


def test_upsert(current, batch):
    once = upsert(current, batch, ["k"], ["t"])
    assert tuples(once) == [("a", 1, 1), ("b", 8, 3), ("c", 3, 2), (None, 7, 2)]
    assert tuples(upsert(once, batch, ["k"], ["t"])) == tuples(once)


def test_replace_by_key_and_slice(current, batch):
    once = replace_by_key(current, batch, ["k"])
    assert tuples(once, "k", "v") == [("a", 1), ("b", 8), ("b", 9), ("c", 3), (None, 7)]
    assert tuples(replace_by_key(once, batch, ["k"])) == tuples(once)
    day = replace_slice(current, batch, "t")
    assert tuples(replace_slice(day, batch, "t")) == tuples(day)
    assert day.count() == 7


def test_merge_dim(spark):
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2)
    now = spark.createDataFrame(
        [(1, "a", "old", first), (2, "b", "old", first)],
        "sk bigint, k string, name string, load_dttm timestamp",
    )
    batch = spark.createDataFrame(
        [("b", "new", 1), ("b", "newer", 2), ("d", "x", 1), ("c", "y", 1)], "k string, name string, t int"
    )
    merged = merge_dim(now, batch, ["k"], ["name"], second, sk="sk", order_by=["t"])
    assert tuples(merged) == [
        (1, "a", "old", first), (2, "b", "newer", second), (3, "c", "y", second), (4, "d", "x", second)
    ]
    again = merge_dim(merged, batch, ["k"], ["name"], second, sk="sk", order_by=["t"])
    assert tuples(again) == tuples(merged)


def test_update_from_keeps_a_null_that_arrives(spark, current):
    updates = spark.createDataFrame([("a", None)], "k string, v int")
    assert tuples(update_from(current, updates, ["k"], ["v"]), "k", "v") == [
        ("a", None), ("b", 2), (None, 0)
    ]


def test_changed_keys(spark):
    at = lambda d: datetime(2024, 1, d)
    fact = spark.createDataFrame(
        [(1, 10, at(1)), (2, 20, at(1)), (3, 30, at(5)), (4, 10, at(1))], "c int, p int, load_dttm timestamp"
    )
    products = spark.createDataFrame([(10, at(1)), (20, at(6))], "p int, load_dttm timestamp")
    people = spark.createDataFrame([(4, at(7)), (9, at(7))], "c int, load_dttm timestamp")
    since = F.lit(at(4))
    assert tuples(changed_keys(fact, "c", [(people, "c"), (products, "p")], since)) == [(2,), (3,), (4,)]


def test_dim_increment_takes_the_latest_name_and_no_null_key(spark):
    staged = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (None, "x", 1), (2, "b", 1)], "id int, name string, t int"
    )
    empty = staged.select("id", "name").limit(0)
    once = dim_increment(empty, staged, "id", ["name"], ["t"])
    assert tuples(once) == [(1, "new"), (2, "b")]
    assert tuples(dim_increment(once, staged, "id", ["name"], ["t"])) == tuples(once)


def test_conform_union(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, name string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "title string, no int")
    maps = [(a, {"id": "id", "name": "name"}), (b, {"id": "no", "name": F.col("title")})]
    assert tuples(conform_union(maps)) == [(1, "x"), (2, "y")]
    assert conform_union(maps, distinct=False).count() == 4
    with pytest.raises(ValueError, match="id"):
        conform_union([(a, {"id": "id", "name": "name"}), (b, {"id": "title", "name": "title"})])
    with pytest.raises(ValueError, match="differ"):
        conform_union([(a, {"id": "id"}), (b, {"no": "no"})])


def test_decompose_rebuilds_the_wide_table(spark):
    wide = spark.createDataFrame(
        [("Kia", "KR", "Rio", 5), ("Kia", "KR", "Rio", 6), ("Kia", "RU", "Rio", 7), (None, None, "T", 8)],
        "brand string, country string, model string, price int",
    )
    dims, fact = decompose(
        wide,
        [
            DimSpec("brands", ["brand", "country"], "brand_id"),
            DimSpec("models", ["model", "brand", "country"], "model_id", ["brands"]),
        ],
        FactSpec(["price"], ["models"]),
    )
    assert dims["models"].columns == ["model_id", "model", "brand_id"] or set(
        dims["models"].columns
    ) == {"model_id", "model", "brand_id"}
    back = fact.join(dims["models"], "model_id").join(dims["brands"], "brand_id")
    assert tuples(back, "brand", "country", "model", "price") == tuples(wide)
    assert dims["brands"].count() == 3 and fact.count() == 4


def test_numbered_dimensions_are_stored(spark):
    """Without this their size is unknown and the wide rows are shuffled for each of them."""
    wide = spark.range(20).select((F.col("id") % 3).cast("string").alias("brand"), F.col("id").alias("price"))
    dims, fact = decompose(wide, [DimSpec("brands", ["brand"], "brand_id")], FactSpec(["price"], ["brands"]))
    assert dims["brands"].inputFiles()
    assert "SortMergeJoin" not in plan_of(fact) and "BroadcastHashJoin" in plan_of(fact)
    assert tuples(fact.join(dims["brands"], "brand_id"), "brand", "price") == tuples(wide, "brand", "price")


def test_resolve_keys(spark):
    fact = spark.createDataFrame([("a", 1), ("z", 2)], "k string, v int")
    dim = spark.createDataFrame([(7, "a")], "sk int, name string")
    assert tuples(resolve_keys(fact, [(dim, {"k": "name"}, "sk")]), "v", "sk") == [(1, 7), (2, None)]
    assert tuples(resolve_keys(fact, [(dim, {"k": "name"}, "sk")], "inner"), "v") == [(1,)]


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;name\n1;x\n2;y;surplus\nbad;z\n4;w\n")
    good, bad = read_csv_with_rejects(spark, str(tmp_path / "a.csv"), "id int, name string", sep=";")
    assert tuples(good) == [(1, "x"), (4, "w")]
    assert tuples(bad, "_rejected_line") == [("2;y;surplus",), ("bad;z",)]
    # asking for few columns must not let bad rows through
    assert good.select("name").count() == 2 and good.count() == 2 and bad.count() == 2
    (tmp_path / "b.csv").write_text("1, a b, 2.50\n2, c, 3.00\n")
    rows = read_rows(spark, str(tmp_path / "b.csv"), "id int, name string, price decimal(5,2)")
    assert tuples(rows, "id", "name") == [(1, "a b"), (2, "c")]
    (tmp_path / "c.csv").write_text("id,name\n1,x\n")
    assert tuples(read_csv(spark, str(tmp_path / "c.csv"), "id int, name string")) == [(1, "x")]


def test_partitioned_sink_replaces_only_its_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "jan"), (2, "feb")], "v int, month string")
    write_partitioned(df, f"{tmp_path}/m", ["month"])
    write_partitioned(df.where("month = 'jan'").withColumn("v", F.lit(9)), f"{tmp_path}/m", ["month"])
    stored = spark.read.parquet(f"{tmp_path}/m")
    assert tuples(stored, "v", "month") == [(2, "feb"), (9, "jan")]
    assert "PartitionFilters: [isnotnull(month" in plan_of(stored.where("month = 'jan'"))


def test_documents_and_refresh(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "a", datetime(2024, 1, 1)), (1, "b", datetime(2024, 1, 2)), (None, "x", None)],
        "id int, name string, ts timestamp",
    )
    landed = land_documents(rows, "id", "ts")
    assert tuples(landed, "object_id", "object_value") == [("1", '{"id":1,"name":"b"}')]
    assert tuples(refresh_table(landed, f"{tmp_path}/d"), "object_id") == [("1",)]
    assert tuples(refresh_table(landed.limit(0), f"{tmp_path}/d")) == []


def test_refresh_keeps_the_old_table_when_it_fails(spark, tmp_path):
    path = f"{tmp_path}/mart"
    stored = refresh_table(spark.range(5), path)
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        refresh_table(broken, path)
    assert tuples(spark.read.parquet(path), "id") == [(k,) for k in range(5)]
    again = refresh_table(stored.where("id > 2").unionAll(spark.range(7, 8)), path)
    assert tuples(again, "id") == [(3,), (4,), (7,)]
    assert tuples(spark.read.parquet(path), "id") == [(3,), (4,), (7,)]
    assert sorted(f for f in os.listdir(tmp_path) if f.startswith("mart.old")) == []


def test_day_predicates():
    assert day_predicates("t", date(2024, 2, 28), date(2024, 2, 29)) == [
        "t >= DATE '2024-02-28' AND t < DATE '2024-02-29'",
        "t >= DATE '2024-02-29' AND t < DATE '2024-03-01'",
    ]


def test_table_store(spark, tmp_path, current, batch):
    store = TableStore(spark, f"{tmp_path}/t", current.schema)
    assert not store.exists() and store.read().count() == 0
    assert store.publish(current, "2024-01-01")
    assert store.change(lambda now: upsert(now, batch, ["k"], ["t"]), "2024-01-02")
    after = tuples(store.read())
    assert not store.change(lambda now: now.limit(0), "2024-01-02") and tuples(store.read()) == after
    assert store.append(batch.where("k = 'c'"), "2024-01-03")
    assert store.read().count() == 5 and store.written("2024-01-03").count() == 1
    # a write that never finished is not visible
    (tmp_path / "t" / "v=00000009-full-broken").mkdir()
    assert store.read().count() == 5
    assert store.publish(current, "2024-01-04") and tuples(store.read()) == tuples(current)


def test_status_changes_and_rekey(spark):
    items = spark.createDataFrame([("a", "available"), ("b", "reserve")], "vin string, status string")
    sales = spark.createDataFrame([("s1", "a"), ("s2", "b")], "no string, car string")
    sold = apply_status(items, sales, "vin", "car")
    assert tuples(sold) == [("a", "sold"), ("b", "sold")]
    undo = spark.createDataFrame([("s1",)], "no string")
    back, rest = revert_status(sold, sales, undo, "no", "vin", "car")
    assert tuples(back) == [("a", "available"), ("b", "sold")] and tuples(rest) == [("s2", "b")]
    mapping = spark.createDataFrame([("a", "z")], "old string, new string")
    new_items, new_sales = rekey([(items, "vin"), (sales, "car")], mapping)
    assert tuples(new_items, "vin") == [("b",), ("z",)]
    assert tuples(new_sales) == [("s1", "z"), ("s2", "b")]
