from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_lon), F.lit(2.0))
    # rounding may lift h just above 1; least() would turn an unknown h into 1
    capped = F.when(h > 1, F.lit(1.0)).otherwise(h)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(capped))


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Point on the unit sphere; squared chords order like great circles."""
    return (
        F.cos(F.radians(lat)) * F.cos(F.radians(lon)),
        F.cos(F.radians(lat)) * F.sin(F.radians(lon)),
        F.sin(F.radians(lat)),
    )
