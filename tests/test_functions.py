from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from martkit.functions import (
    age_years,
    hash_long,
    haversine_km,
    json_set,
    json_text,
    local_time,
    md5_key,
    week_start,
)


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_haversine(spark):
    lit = F.lit
    assert one(spark, haversine_km(lit(55.75), lit(37.62), lit(59.94), lit(30.31))) == pytest.approx(634, abs=3)
    assert one(spark, haversine_km(lit(10.0), lit(20.0), lit(10.0), lit(20.0))) == 0.0
    across = one(spark, haversine_km(lit(0.0), lit(179.999), lit(0.0), lit(-179.999)))
    assert across == pytest.approx(0.222, abs=0.001)
    opposite = one(spark, haversine_km(lit(0.0), lit(0.0), lit(0.0), lit(180.0)))
    assert opposite == pytest.approx(20015.09, abs=0.1)


def test_keys_tell_nulls_and_parts_apart(spark):
    keys = {
        one(spark, md5_key(F.lit("a"), F.lit("bc"))),
        one(spark, md5_key(F.lit("ab"), F.lit("c"))),
        one(spark, md5_key(F.lit("a"), F.lit(None).cast("string"))),
        one(spark, md5_key(F.lit("a"), F.lit(""))),
    }
    assert len(keys) == 4
    assert 0 <= one(spark, hash_long(F.lit("a"))) < 2**60


def test_json_set(spark):
    doc = '{"Coffee":{"Espresso":100,"Latte":150},"Main":{"Soup":200}}'
    schema = "map<string,map<string,int>>"
    changed = one(spark, json_set(F.lit(doc), ["Coffee", "Latte"], F.lit(180), schema))
    assert json.loads(changed) == {
        "Coffee": {"Espresso": 100, "Latte": 180},
        "Main": {"Soup": 200},
    }
    assert one(spark, json_set(F.lit(doc), ["Coffee", "Mocha"], F.lit(1), schema)) == doc
    inner = one(spark, json_set(F.lit('{"a":{"b":1}}'), ["a", "b"], F.lit(2), "a struct<b: int>"))
    assert json.loads(inner) == {"a": {"b": 2}}


def test_json_text_with_cyrillic_key(spark):
    assert one(spark, json_text(F.lit('{"Кофе":{"Капучино":170}}'), "Кофе", "Капучино")) == "170"


def test_dates(spark):
    day = lambda s: F.lit(s).cast("date")
    assert one(spark, age_years(day("2000-02-29"), day("2024-02-28"))) == 23
    assert one(spark, age_years(day("2000-02-29"), day("2024-02-29"))) == 24
    assert str(one(spark, week_start(day("2024-12-31")))) == "2024-12-30"
    assert one(spark, F.weekofyear(day("2024-12-31"))) == 1
    at = F.lit("2024-01-15 12:00:00").cast("timestamp")
    assert str(one(spark, local_time(at, F.lit("Asia/Tokyo")))) == "2024-01-15 21:00:00"
    assert str(one(spark, local_time(at, F.lit(None).cast("string")))) == "2024-01-15 12:00:00"
