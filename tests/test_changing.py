"""Event logs, day slices, key buckets and incremental runs on hand-made rows."""

from __future__ import annotations

import random
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.operators.load import rekey
from martkit.operators.vault import changes_of_log, latest_of_log, log_events
from martkit.plans import standins
from martkit.sources.runs import finished_runs, read_mart, run_increment, watermark
from martkit.sources.slices import change_buckets, overwrite_slices, read_buckets, read_table, upsert_buckets
from tests.conftest import plan_of, tuples

T1 = datetime(2024, 1, 1)
EVENT = "user string, state string, at timestamp, no int"


def _log(spark, path, batches):
    for token, rows in batches:
        log_events(spark.createDataFrame(rows, EVENT), path, token, "hk", ["state"], ["at", "no"], T1, "s", bks=["user"])
    return spark.read.parquet(path)


def test_any_split_of_the_events_gives_one_history(spark, tmp_path):
    day = lambda d: datetime(2024, 1, d)
    late = [("late", [("u", "A", day(1), 1), ("u", "A", day(3), 1)]), ("later", [("u", "B", day(2), 1), (None, "X", day(2), 2)])]
    log = _log(spark, f"{tmp_path}/late", late)
    assert [r.state for r in changes_of_log(log, "hk", ["at", "no"]).orderBy("at").collect()] == ["A", "B", "A"]

    rng = random.Random(4)
    rows = [(rng.choice("uvw"), rng.choice("AB"), day(rng.randint(1, 9)), k) for k in range(80)]
    found = []
    for n in (1, 3, 8):
        shuffled = rng.sample(rows, len(rows))
        batches = [(f"t{k}", shuffled[k::n]) for k in range(n)]
        log = _log(spark, f"{tmp_path}/split{n}", [*batches, batches[0], ("again", batches[-1][1])])
        found.append(tuples(changes_of_log(log, "hk", ["at", "no"]), "hk", "state", "at", "no"))
        assert tuples(latest_of_log(log, "hk", ["at", "no"]), "no") == sorted(
            [(max((r[2], r[3]) for r in rows if r[0] == u)[1],) for u in "uvw"], key=str
        )
    assert found[0] == found[1] == found[2] and len(found[0]) < len(rows)


def _files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("part-*")}


def test_rerun_of_a_slice_touches_its_files_only(spark, tmp_path):
    path = f"{tmp_path}/days"
    schema = "n int, day date"
    rows = spark.createDataFrame([(k, date(2024, 1, 1 + k % 3)) for k in range(9)] + [(9, None)], schema)
    overwrite_slices(rows, path, "day")
    before = _files(path)
    overwrite_slices(spark.createDataFrame([(50, date(2024, 1, 2))], schema), path, "day", [date(2024, 1, 2), date(2024, 1, 3)])
    kept = {f: t for f, t in before.items() if "01-02" not in f and "01-03" not in f}
    assert kept and {f: t for f, t in _files(path).items() if f in before} == kept
    stored = read_table(spark, path, rows.schema)
    assert tuples(stored, "n") == sorted([(0,), (3,), (6,), (9,), (50,)], key=str)
    pruned = plan_of(stored.where(F.col("day") == F.lit("2024-01-02").cast("date")))
    assert "PartitionFilters: [isnotnull(day" in pruned


def test_upsert_reads_and_writes_the_buckets_of_its_batch(spark, tmp_path):
    path = f"{tmp_path}/state"
    schema = T._parse_datatype_string("k bigint, v string, at int")
    frame = lambda rows: spark.createDataFrame(rows, schema)
    assert upsert_buckets(spark, path, schema, frame([]), ["k"], ["at"], 16) == []
    upsert_buckets(spark, path, schema, frame([(k, "old", 0) for k in range(200)] + [(None, "old", 0)]), ["k"], ["at"], 16)
    before = _files(path)
    batch = frame([(7, "a", 1), (7, "b", 2), (500, "new", 1), (None, "c", 1)])
    plans = []

    def step(now, new):
        plans.append(plan_of(now))
        from martkit.operators.load import upsert

        return upsert(now, new, ["k"], ["at"])

    touched = change_buckets(spark, path, schema, batch, ["k"], step, 16)
    assert len(touched) <= 3 and "PartitionFilters: [bucket" in plans[0]
    after = _files(path)
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if any(f"bucket={b}/" in f for b in touched)}
    want = {k: "old" for k in range(200)} | {7: "b", 500: "new", None: "c"}
    assert {r.k: r.v for r in read_buckets(spark, path, schema).collect()} == want
    change_buckets(spark, path, schema, batch, ["k"], step, 16)
    assert read_buckets(spark, path, schema).count() == len(want)


def test_runs_publish_rows_and_progress_together(spark, tmp_path):
    base = f"{tmp_path}/mart"
    schema = T._parse_datatype_string("k int, total bigint")
    day = lambda d: datetime(2024, 1, d)
    rows = [(1, 10, day(1)), (2, 5, day(1)), (1, 1, day(2)), (3, 7, day(3)), (2, 2, day(4))]
    asked = []

    def run(until, fail=False):
        seen = spark.createDataFrame(rows, "k int, v int, at timestamp").where(F.col("at") <= F.lit(day(until)))

        def step(since):
            asked.append(since)
            keys = seen.where(F.col("at") > since).select("k").distinct()
            out = seen.join(keys, "k", "left_semi").groupBy("k").agg(F.sum("v").alias("total"))
            return out.withColumn("total", F.raise_error(F.lit("lost")).cast("bigint")) if fail else out

        return run_increment(spark, base, seen, "at", step)

    read = lambda: tuples(read_mart(spark, base, schema, ["k"]))
    assert read() == [] and watermark(spark, base) is None
    assert run(1) and read() == [(1, 10), (2, 5)]
    with pytest.raises(Exception, match="lost"):
        run(3, fail=True)
    assert finished_runs(spark, base) == [1] and watermark(spark, base) == day(1) and read() == [(1, 10), (2, 5)]
    assert run(3) and read() == [(1, 11), (2, 5), (3, 7)]
    assert not run(3)
    assert run(4) and read() == [(1, 11), (2, 7), (3, 7)] and finished_runs(spark, base) == [1, 2, 3]


def test_rekey_never_multiplies_rows(spark):
    items = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "vin string, n int")
    mapping = spark.createDataFrame([("x", "z"), ("x", "w"), ("y", None), (None, "q")], "old string, new string")
    assert tuples(rekey([(items, "vin")], mapping)[0]) == sorted([("w", 1), ("y", 2), (None, 3)], key=str)


def test_days_outside_the_usual_calendar_count(spark):
    """Rates and calendars follow the days of the data."""
    class Tables:
        def __call__(self, name):
            if name == "orders":
                return spark.createDataFrame([(datetime(1990, 5, 1),), (datetime(1990, 5, 3),)], "o_orderdate timestamp")
            return spark.createDataFrame([(4,)], "n_nationkey int")

    rates = standins.currency_rates(Tables())
    assert [str(r.date_update) for r in rates.orderBy("date_update").collect()] == ["1990-05-01", "1990-05-02", "1990-05-03"]
