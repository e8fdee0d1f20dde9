from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(day: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(day, "yyyy-MM")


def week_start(day: Column) -> Column:
    """Monday of the week, as a date."""
    return F.to_date(F.date_trunc("week", day))


def age_years(born: Column, on: Column) -> Column:
    """Full years between two dates."""
    return F.floor(F.months_between(on, born) / 12).cast("int")


def local_time(utc: Column, zone: Column) -> Column:
    """Wall-clock time in ``zone``; UTC where the zone is unknown."""
    return F.from_utc_timestamp(utc, F.coalesce(zone, F.lit("UTC")))
