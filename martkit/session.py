"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(app: str = "martkit", cores: str | int = "*", **conf: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MARTKIT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is absent and the
    master is local.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="martkit-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """New, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs in it delete their shuffle files as they end; else these stay until the driver collects its garbage.

    A setting of the session: for one thread, around a write that ends the lineage.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def settle(df):
    """Write ``df`` to the reliable checkpoint folder and continue from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Bytes of stored input per partition of ``spread``.
SPREAD_BYTES = 4 << 20


def _stored_bytes(*dfs) -> int:
    """Bytes of the input files of ``dfs``, each file once."""
    spark = dfs[0].sparkSession
    size = 0
    for file in {file for df in dfs for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return size


def spread_parts(*dfs) -> int:
    """Partitions that ``spread`` deals the rows of ``dfs`` into, by their input files; 0 if these are small."""
    spark = dfs[0].sparkSession
    size = _stored_bytes(*dfs)
    if size < 8 * SPREAD_BYTES:
        return 0
    # fewer than Spark's own number would be shuffled again
    return max(size // SPREAD_BYTES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df, *keys: str, like=None):
    """``df`` dealt by ``keys`` into partitions whose number grows with its input files.

    Spark merges shuffled partitions up to a size that counts compressed bytes;
    narrow or repetitive rows then need many times as much memory in one task.
    An explicit number is left as it is, so the memory of a task stays bounded.
    Use it where a join or aggregate by ``keys`` shuffles the rows anyhow. Small
    or unstored inputs stay as they are. ``like`` is the frame whose input files
    count instead of those of ``df``, where both are to have as many partitions.
    """
    parts = spread_parts(df if like is None else like)
    return df.repartition(parts, *keys) if parts else df


#: Bytes of input files below which no rows are counted for ``unbroadcast``.
COUNT_BYTES = 256 << 10


def unbroadcast(df):
    """``df``, hinted to meet others in a merge join if its rows are more than Spark's bound on a broadcast.

    Spark takes the size of a table from its files. Rows that compress well, or
    of which a plan reads few columns, need many times as much memory, all of
    which passes through the driver. So the rows are counted: ``df`` should be a
    stored table or columns of one. Small or unstored inputs stay as they are.
    """
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if most < 0 or _stored_bytes(df) < COUNT_BYTES:
        return df
    row = 8 + df._jdf.schema().defaultSize()
    return df.hint("merge") if df.count() * row > most else df
