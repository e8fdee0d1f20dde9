"""Invalid coordinates give null by raster and by grid alike."""

from __future__ import annotations

from martkit.operators.points import nearest_point


def test_invalid_coordinates(spark):
    nan, inf = float("nan"), float("inf")
    given = [(1, 10.0, 20.0), (2, -95.0, 0.0), (3, 90.5, 0.0), (4, nan, 0.0), (5, 0.0, nan), (6, 0.0, inf), (7, None, 1.0), (8, -90.0, 540.0), (9, 90.0, -181.0)]
    places = [(1, 11.0, 20.0), (2, -80.0, 0.0), (3, nan, 0.0), (4, 95.0, 0.0), (5, 0.0, nan), (6, 80.0, 0.0), (7, 0.0, None)]
    events = spark.createDataFrame(given, "event int, lat double, lon double")
    spots = spark.createDataFrame(places, "place int, lat double, lon double").withColumnsRenamed({"lat": "plat", "lon": "plon"})
    got = []
    for packed in (1000, 1):
        found = nearest_point(events, spots, "event", "place", place_lat="plat", place_lon="plon", max_packed=packed)
        got.append({r.event: (r.place, r.distance_km is None) for r in found.collect()})
    nothing = (None, True)
    assert got[0] == got[1]
    assert got[0] == {1: (1, False), **dict.fromkeys(range(2, 8), nothing), 8: (2, False), 9: (6, False)}
