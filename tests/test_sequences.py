from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martkit.operators.ordinals import assign_ids, global_ordinal
from martkit.operators.sequences import (
    calendar_dim,
    change_points,
    islands,
    longest_island,
    ordinal_within,
)
from tests.conftest import plan_of, tuples

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        user = rng.choice(["hot", "hot", "hot", "cold", None])
        at = START + timedelta(hours=rng.randrange(24 * 12))
        rows.append((i, user, at, rng.choice(["A", "B", None])))
    return spark.createDataFrame(rows, "id int, user string, ts timestamp, city string").cache()


def by_hand(visits):
    """Islands and previous values computed in plain Python."""
    runs, previous, ordinals = [], {}, {}
    rows = sorted(visits.collect(), key=lambda r: (str(r.user), r.ts, r.id))
    last = {}
    for r in rows:
        ordinals[r.id] = ordinals_of = last.get(r.user, (None, 0, 0))[1] + 1
        first = r.user not in last
        if first or last[r.user][0] != r.city:
            if not first:
                previous[r.id] = last[r.user][0]
            no = last[r.user][2] + 1 if not first else 1
            runs.append([r.user, no, r.city, r.ts, r.ts, 1])
        else:
            no = last[r.user][2]
            run = next(x for x in reversed(runs) if x[0] == r.user)
            run[4], run[5] = r.ts, run[5] + 1
        last[r.user] = (r.city, ordinals_of, no)
    return sorted(map(tuple, runs), key=str), previous, ordinals


def test_islands_changes_and_ordinals_across_chunks(visits):
    runs, previous, ordinals = by_hand(visits)
    order = ["ts", "id"]
    cols = ["user", "island_no", "city", "started", "ended", "row_count"]
    for chunk in (None, F.date_trunc("hour", "ts"), F.lit(1)):
        assert tuples(islands(visits, ["user"], order, "city", chunk), *cols) == runs
    changed = change_points(visits, ["user"], order, "city")
    assert {r.id: r.previous for r in changed.collect()} == previous
    numbered = ordinal_within(visits, ["user"], order)
    assert {r.id: r.ordinal for r in numbered.collect()} == ordinals


def test_a_stay_of_exactly_the_minimum_counts(spark):
    rows = [
        ("u", 1, START, "A"), ("u", 2, START + timedelta(days=27), "A"),
        ("u", 3, START + timedelta(days=28), "B"), ("u", 4, START + timedelta(days=55), "B"),
        ("u", 5, START + timedelta(days=56), "A"),
        ("v", 6, START, "A"), ("v", 7, START + timedelta(days=26), "A"),
    ]
    df = spark.createDataFrame(rows, "user string, id int, ts timestamp, city string")
    runs = islands(df, ["user"], ["ts", "id"], "city")
    assert tuples(longest_island(runs, ["user"], 27), "user", "city", "stay_days") == [("u", "B", 27)]


def test_calendar(spark):
    days = calendar_dim(spark, date(2024, 12, 28), date(2025, 1, 1))
    assert tuples(days, "date_id", "week_of_year", "weekend") == [
        (20241228, 52, True), (20241229, 52, True), (20241230, 1, False),
        (20241231, 1, False), (20250101, 1, False),
    ]


def test_global_ordinal(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("g"), F.xxhash64("id").alias("k"))
    numbered = global_ordinal(df.repartition(6), ["g", "k"], start=100)
    plain = df.withColumn("want", F.row_number().over(Window.orderBy("g", "k")) + 99)
    wrong = numbered.join(plain, ["g", "k"]).where("ordinal <> want")
    assert numbered.count() == 5000 and wrong.count() == 0
    # only the partition sizes, already aggregated, meet in one task
    plan = plan_of(numbered)
    assert plan.count("SinglePartition") == 1
    assert "HashAggregate" in plan.split("SinglePartition")[1]


def test_ids_continue_and_are_stable(spark):
    names = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    first = assign_ids(names, None, "id", ["name"])
    assert tuples(first) == [(1, "a"), (2, "b"), (3, "c")]
    more = assign_ids(spark.createDataFrame([("z",), ("d",)], "name string"), first, "id", ["name"])
    assert tuples(more) == [(4, "d"), (5, "z")]
    assert tuples(assign_ids(names.orderBy(F.desc("name")), None, "id", ["name"])) == tuples(first)
