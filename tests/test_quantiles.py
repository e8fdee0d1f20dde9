"""Exact medians against the standard library, with a hot group, ties, nulls and null keys."""

from __future__ import annotations

import random
import statistics
from collections import defaultdict

from pyspark.sql import functions as F

from martkit.operators.quantiles import exact_median


def test_medians_of_uneven_groups(spark):
    rng = random.Random(3)
    rows = [("hot", rng.randint(0, 300)) for _ in range(3000)] + [("tied", 7)] * 500
    rows += [(rng.choice(["a", "b", None]), rng.choice([None, rng.randint(-5, 5)])) for _ in range(200)] + [("one", 4), ("two", 1), ("two", 2), ("none", None)]
    want = defaultdict(list)
    for g, v in rows:
        if v is not None:
            want[g].append(v)
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    got = {r.g: r.median for r in exact_median(df, ["g"], "v").collect()}
    assert got == {g: statistics.median(v) for g, v in want.items()}
    assert exact_median(df, [], "v").first()[0] == statistics.median(v for vs in want.values() for v in vs)
    assert exact_median(df.limit(0), ["g"], "v").count() == 0


def test_a_hot_group_spreads_over_ranges(spark):
    """No range of a group of all rows holds more than its share."""
    df = spark.range(20_000).select(F.lit("all").alias("g"), (F.col("id") * 7919 % 20_000).alias("v"))
    counted = df.groupBy("g", "v").count().repartitionByRange(8, "g", "v")
    sizes = [r["count"] for r in counted.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20_000 / 8 * 2
    assert exact_median(df, ["g"], "v").first().median == 9999.5
