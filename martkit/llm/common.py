"""Stored intermediate tables and small column helpers of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martkit.session import scratch_path, shuffles_dropped


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again.

    Cuts the lineage with files all executors share, and lets Spark drop the
    shuffle files of the step, which would otherwise stay until the driver
    collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
