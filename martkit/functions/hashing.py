from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"
NULL_MARK = "\\N"


def _text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(NULL_MARK))


def md5_key(*cols: Column | str) -> Column:
    """128-bit hex key of the delimited parts; a null part has its own mark."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *[_text(c) for c in parts]))


def hash_long(*cols: Column | str) -> Column:
    """60-bit integer key: the first 15 hex digits of :func:`md5_key`."""
    return F.conv(F.substring(md5_key(*cols), 1, 15), 16, 10).cast("bigint")
