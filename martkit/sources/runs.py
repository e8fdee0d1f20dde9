"""Incremental mart runs whose progress is stored with their rows.

Every run writes one folder ``run=<n>``. Its rows carry the watermark the run
reached, so data and progress are one write and become visible together, by
Spark's ``_SUCCESS`` file. A run that dies leaves a folder that nobody reads and
that the next run, which starts from the last watermark again, writes over.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.operators.select import latest_per_key

RUN, REACHED = "run", "loaded_to"


def finished_runs(spark: SparkSession, base: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(base)):
        return []
    names = [s.getPath() for s in fs.listStatus(path(base))]
    numbers = [(re.fullmatch(rf"{RUN}=(\d+)", p.getName()), p) for p in names]
    return sorted(int(m[1]) for m, p in numbers if m and fs.exists(path(p, "_SUCCESS")))


def _run_path(base: str, n: int) -> str:
    return f"{base.rstrip('/')}/{RUN}={n}"


def watermark(spark: SparkSession, base: str) -> datetime | None:
    """Watermark of the last finished run; only its one column is read."""
    for n in reversed(finished_runs(spark, base)):
        reached = spark.read.parquet(_run_path(base, n)).agg(F.max(REACHED)).first()[0]
        if reached is not None:
            return reached
    return None


def run_increment(
    spark: SparkSession,
    base: str,
    loaded: DataFrame,
    load_col: str,
    step: Callable[[Column], DataFrame],
) -> bool:
    """One run: rows of ``step(since)`` are published with the greatest ``load_col`` of ``loaded``.

    ``step`` gives the mart rows that changes after ``since`` touch, from sources
    no later than ``loaded``; ``since`` is a literal, the beginning of time for the
    first run. Without a later load nothing is written and False comes back. One
    run at a time per ``base``.
    """
    before = watermark(spark, base)
    since = F.lit(before) if before is not None else F.lit("0001-01-01 00:00:00")
    since = since.cast(loaded.schema[load_col].dataType)
    reached = loaded.where(F.col(load_col) > since).agg(F.max(load_col)).first()[0]
    if reached is None:
        return False
    runs = finished_runs(spark, base)
    n = runs[-1] + 1 if runs else 1
    told = F.lit(reached).cast(loaded.schema[load_col].dataType)
    step(since).withColumn(REACHED, told).write.mode("overwrite").parquet(_run_path(base, n))
    return True


def read_mart(spark: SparkSession, base: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Rows of all finished runs, of each key those of the last run that wrote it."""
    runs = finished_runs(spark, base)
    if not runs:
        return spark.createDataFrame([], schema)
    # basePath makes the folder name the column ``run``
    read = T.StructType([*schema.fields, T.StructField(RUN, T.IntegerType())])
    rows = spark.read.schema(read).option("basePath", base).parquet(*[_run_path(base, n) for n in runs])
    return latest_per_key(rows, keys, [RUN]).drop(RUN)
