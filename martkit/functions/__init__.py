"""Column functions."""

from martkit.functions.dates import age_years, local_time, month_key, week_start
from martkit.functions.geo import haversine_km
from martkit.functions.hashing import hash_long, md5_key
from martkit.functions.json import json_entries, json_items, json_set, json_text

__all__ = [
    "age_years",
    "hash_long",
    "haversine_km",
    "json_entries",
    "json_items",
    "json_set",
    "json_text",
    "local_time",
    "md5_key",
    "month_key",
    "week_start",
]
