from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Give frames names that ``spark.sql`` statements can use."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
