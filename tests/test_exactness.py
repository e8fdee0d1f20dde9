"""Cases the stand-in tables do not hold."""

from __future__ import annotations

import os
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest

from martkit.sources.store import TableStore
from martkit.operators.load import resolve_keys, update_from
from martkit.operators.select import slice_by_date
from martkit.sources.files import read_rows
from martkit.streaming.decode import decode_json, malformed, well_formed


def test_messages_without_content_are_malformed(spark):
    df = spark.createDataFrame([('{"a": 1}',), (None,), ("",), ("  ",), ("null",), ("{oops",)], "value string")
    out = decode_json(df, "a int").cache()
    assert [tuple(r) for r in well_formed(out).collect()] == [(1,)]
    assert sorted(r.value for r in malformed(out).collect()) == ["", "", "  ", "null", "{oops"]


def test_day_slice_in_another_process_zone():
    code = (
        "from datetime import date; from martkit.session import local_session; "
        "from martkit.operators.select import slice_by_date; s = local_session('zone', 1); "
        "df = s.sql(\"select timestamp'2024-01-14 16:00:00' as ts union all select timestamp'2024-01-15 23:00:00'\"); "
        "print('rows', [str(r.t) for r in slice_by_date(df, 'ts', date(2024, 1, 15)).selectExpr('string(ts) as t').collect()])"
    )
    root = str(Path(__file__).resolve().parents[1])
    env = os.environ | {"TZ": "Asia/Tokyo", "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, timeout=120)
    assert "rows ['2024-01-15 23:00:00']" in done.stdout


def test_day_slice_of_dates(spark):
    df = spark.sql("select date'2024-01-15' as d union all select date'2024-01-16'")
    assert slice_by_date(df, "d", date(2024, 1, 15)).count() == 1


def test_bad_text_rows_fail(spark, tmp_path):
    (tmp_path / "rows.txt").write_text("1, a\nx, b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_rows(spark, str(tmp_path / "rows.txt"), "id int, name string").collect()


def test_repeated_keys_do_not_multiply_rows(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    assert sorted(map(tuple, update_from(target, updates, ["k"], ["v"]).collect())) == [(1, "y"), (2, "b")]
    dim = spark.createDataFrame([("a", 7), ("a", 5), ("b", 9)], "name string, id int")
    got = resolve_keys(target, [(dim, {"v": "name"}, "id")]).collect()
    assert sorted((r.k, r.id) for r in got) == [(1, 5), (2, 9)]


def test_different_tokens_are_stored_apart(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "a int")
    store = TableStore(spark, f"{tmp_path}/towns", rows.schema)
    assert store.append(rows, "Москва") and store.append(rows, "Казань") and store.append(rows, "a_b")
    assert not store.append(rows, "Казань")
    assert store.read().count() == 3 and store.written("Казань").count() == 1
