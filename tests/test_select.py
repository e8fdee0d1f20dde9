from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from martkit.operators.load import load_next_batch
from martkit.operators.quality import (
    ensure_columns,
    find_duplicates,
    find_orphans,
    null_share,
    one_of,
    split_valid,
)
from martkit.operators.select import (
    active_at,
    best_per_group,
    count_by_value,
    flag_first,
    latest_per_key,
    ordered_list,
    ranked_first,
    signed_amount,
    slice_by_date,
    top_k_per_group,
)
from tests.conftest import plan_of, tuples


def test_slice_by_date_is_pushed_to_the_scan(spark, tmp_path):
    rows = [(1, datetime(2024, 1, 1, 23, 59)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 3))]
    spark.createDataFrame(rows, "id int, ts timestamp").write.parquet(f"{tmp_path}/t")
    day = slice_by_date(spark.read.parquet(f"{tmp_path}/t"), "ts", date(2024, 1, 2))
    assert tuples(day, "id") == [(2,)]
    assert "GreaterThanOrEqual(ts" in plan_of(day) and "LessThan(ts" in plan_of(day)


def test_active_at_includes_start_and_excludes_end(spark):
    df = spark.createDataFrame([(1, 10, 20), (2, 5, 10), (3, 11, 12)], "id int, a int, b int")
    assert tuples(active_at(df, "a", "b", F.lit(10)), "id") == [(1,)]


def test_first_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "n"), (None, 4, "m")],
        "k string, v int, s string",
    )
    assert tuples(latest_per_key(df, ["k"], ["v", "s"])) == [("a", 2, "z"), (None, 5, "n")]
    low = best_per_group(df, ["k"], [F.col("v"), F.col("s")], largest=False)
    assert tuples(low) == [("a", 1, "x"), (None, 4, "m")]
    assert "WindowGroupLimit" in plan_of(low)
    top = top_k_per_group(df, ["k"], [F.desc("v"), F.asc("s")], 2)
    assert tuples(top.where("k = 'a'"), "v", "s", "row_no") == [(2, "y", 1), (2, "z", 2)]
    assert "WindowGroupLimit" in plan_of(top)
    assert tuples(ranked_first(df, ["k"], "v"), "s") == [("n",), ("y",), ("z",)]
    assert tuples(ranked_first(df, [], "v"), "s") == [("n",)]


def test_flag_first_ignores_null_keys_and_other_rows(spark):
    df = spark.createDataFrame(
        [(1, "u", 5, "m"), (2, "u", 5, "m"), (3, "u", 1, "r"), (4, None, 0, "m")],
        "id int, k string, ts int, kind string",
    )
    flags = flag_first(df, "k", ["ts", "id"], "id", where=F.col("kind") == "m")
    assert tuples(flags, "id", "is_first") == [(1, 1), (2, 0), (3, 0), (4, 0)]


def test_counts_lists_and_signs(spark):
    df = spark.createDataFrame(
        [("a", 2, "x", Decimal("1.00")), ("a", 1, "y", Decimal("2.00")), ("b", 1, None, Decimal("3.00"))],
        "k string, o int, s string, m decimal(10,2)",
    )
    assert tuples(count_by_value(df, ["k"], "s", {"xs": "x"})) == [("a", 1), ("b", 0)]
    lists = df.groupBy("k").agg(ordered_list(F.col("o"), F.col("s")).alias("l"))
    assert tuples(lists) == [("a", ["y", "x"]), ("b", [None])]
    signs = signed_amount(df, "m", "s", ["x"])
    assert tuples(signs, "m") == [(Decimal("-1.00"),), (Decimal("2.00"),), (Decimal("3.00"),)]


def test_keyset_batches_cover_the_source_once(spark):
    source = spark.range(25).withColumnRenamed("id", "order_id")
    state = spark.createDataFrame([("other", 3)], "workflow string, last_id bigint")
    seen = []
    for _ in range(4):
        batch, state = load_next_batch(source, state, "orders", "order_id", 10)
        seen += [r.order_id for r in batch.collect()]
        state = spark.createDataFrame(state.collect(), state.schema)
    assert seen == list(range(25))
    assert tuples(state) == [("orders", 24), ("other", 3)]


def test_quality(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (2, -1, "a"), (3, None, "z"), (4, -2, "z")], "id int, q int, s string"
    )
    good, bad = split_valid(df, {"not_negative": F.col("q") >= 0, "known": one_of("s", ["a"])})
    assert tuples(good, "id") == [(1,)]
    assert tuples(bad, "id", "failed_rules") == [
        (2, ["not_negative"]), (3, ["known"]), (4, ["not_negative", "known"])
    ]
    assert tuples(find_duplicates(df, ["s"])) == [("a", 2), ("z", 2)]
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    with_null = df.unionByName(spark.createDataFrame([(5, 0, None)], df.schema))
    assert tuples(find_orphans(with_null, parents, ["s"], ["p"]), "id") == [(3,), (4,)]
    share = null_share(df, "s", ["z"]).first()
    assert (share.total_rows, share.missing_rows, share.missing_percent) == (4, 2, 50.0)
    assert null_share(df.limit(0), "s").first().missing_percent is None
    same = ensure_columns(df, {"s": F.lit("no"), "status": F.lit("shipped")})
    assert tuples(same, "s", "status")[0] == ("a", "shipped")
