from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from martkit.operators.pairs import co_occurring_pairs, exclude_known_pairs
from martkit.operators.points import nearest_point, pairs_within_km
from tests.conftest import plan_of, tuples


def km(a, b):
    (y1, x1), (y2, x2) = [(math.radians(p[0]), math.radians(p[1])) for p in (a, b)]
    h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
    return 2 * 6371 * math.asin(min(1.0, math.sqrt(h)))


@pytest.fixture(scope="module")
def crowd():
    """Points at both poles, the equator and 60 degrees across the date line, with twins."""
    rng = random.Random(5)
    out = []
    for lat, lon in [(89.99, 0), (-89.99, 10), (0, 180), (60, -180), (0, 0)]:
        for _ in range(70):
            y = max(-90, min(90, lat + rng.uniform(-0.012, 0.012)))
            spread = 180 if abs(lat) > 80 else 0.012 / math.cos(math.radians(lat))
            x = (lon + rng.uniform(-spread, spread) + 180) % 360 - 180
            out.append((y, x))
    return out + [(0.0, 0.0), (0.0, 0.0), (90.0, 5.0), (90.0, -120.0)]


def as_points(spark, crowd):
    return spark.createDataFrame(
        [(i, float(y), float(x)) for i, (y, x) in enumerate(crowd)], "id int, lat double, lon double"
    )


@pytest.mark.parametrize("block_rows", [4000, 10])
def test_pairs_equal_brute_force(spark, crowd, block_rows):
    points = as_points(spark, crowd)
    want = {
        (i, j)
        for i in range(len(crowd))
        for j in range(i + 1, len(crowd))
        if km(crowd[i], crowd[j]) <= 1
    }
    got = pairs_within_km(points, "id", 1.0, block_rows=block_rows)
    rows = [(r.id_left, r.id_right) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 500
    plan = plan_of(got)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_points_without_coordinates_make_no_pairs(spark):
    points = spark.createDataFrame(
        [(1, 0.0, 0.0), (2, None, 0.0), (3, 0.0, 0.0)], "id int, lat double, lon double"
    )
    assert tuples(pairs_within_km(points, "id"), "id_left", "id_right") == [(1, 3)]


@pytest.mark.parametrize("max_packed", [1000, 0])
def test_nearest_equals_brute_force(spark, max_packed):
    rng = random.Random(9)
    spots = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    spots += [(89.9, 0.0), (-89.9, 90.0), (10.0, 179.99), (10.0, -179.9), (10.0, 179.99)]
    places = spark.createDataFrame(
        [(i, f"c{i}", y, x) for i, (y, x) in enumerate(spots)],
        "city_id int, city string, lat double, lon double",
    )
    asked = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    asked += [(90.0, 0.0), (-90.0, 0.0), (10.0, 180.0), (10.0, -180.0)]
    events = spark.createDataFrame(
        [(i, y, x) for i, (y, x) in enumerate(asked)] + [(9999, None, None)],
        "event_id int, lat double, lon double",
    )
    found = nearest_point(events, places, "event_id", "city_id", keep=["city"], max_packed=max_packed)
    for row in found.collect():
        if row.event_id == 9999:
            assert row.city_id is None and row.distance_km is None
            continue
        best = min(km(asked[row.event_id], s) for s in spots)
        assert row.distance_km == pytest.approx(best, abs=1e-6)
        assert row.city == f"c{row.city_id}" and row.city_id != 64
    if max_packed:
        # the events themselves are neither shuffled nor multiplied
        plan = plan_of(found)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "hashpartitioning" not in plan


def test_shared_group_pairs(spark):
    points = spark.createDataFrame(
        [(1, 0.0, 0.0), (2, 0.001, 0.0), (3, 5.0, 5.0), (4, 0.0, 0.001)], "id int, lat double, lon double"
    )
    members = spark.createDataFrame(
        [(1, "x"), (1, "x"), (2, "x"), (3, "x"), (1, "y"), (2, "y"), (4, "z"), (None, "x")],
        "id int, g string",
    )
    for block_rows in (4000, 1):
        pairs = co_occurring_pairs(members, points, "id", "g", 1.0, block_rows)
        assert tuples(pairs) == [(1, 2)]


def test_known_pairs_in_either_direction(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "id_left int, id_right int")
    edges = spark.createDataFrame([(3, 1), (1, 2), (1, 2), (2, None), (9, 9)], "f int, t int")
    left = exclude_known_pairs(pairs, edges, "f", "t")
    assert tuples(left) == [(2, 3)]
    assert "NestedLoop" not in plan_of(left) and "Cartesian" not in plan_of(left)
