from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.session import shuffles_dropped

REJECT_COL = "_rejected_line"


def _schema(schema: str | T.StructType) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",", header: bool = True
) -> DataFrame:
    """Delimited files with an explicit schema; a malformed line fails the read."""
    return spark.read.csv(path, schema=_schema(schema), sep=sep, header=header, mode="FAILFAST")


def read_csv_with_rejects(
    spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, rejected lines): bad casts and wrong column counts are kept aside."""
    declared = _schema(schema)
    read_as = T.StructType([*declared.fields, T.StructField(REJECT_COL, T.StringType())])
    rows = spark.read.csv(
        path,
        schema=read_as,
        sep=sep,
        header=header,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=REJECT_COL,
        enforceSchema=True,
    )
    # The reader only checks the columns a plan asks for. This condition always
    # holds but needs every column, so a later projection cannot hide a bad value.
    checked = F.hash(*declared.names) >= F.lit(-(2**31))
    rejected = F.col(REJECT_COL).isNotNull()
    return rows.where(~rejected & checked).drop(REJECT_COL), rows.where(rejected & checked)


def read_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Text rows ``a, b, c`` without a header, blanks around values ignored; a malformed row fails the read."""
    return spark.read.csv(
        path,
        schema=_schema(schema),
        header=False,
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
        mode="FAILFAST",
    )


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Parquet partitioned by ``by``; only the partitions present in ``df`` are replaced.

    Rows are rebalanced on the partition columns: few files per partition, and
    a large partition still spreads over several tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*by)
        .parquet(path)
    )


def refresh_table(df: DataFrame, path: str) -> DataFrame:
    """Full refresh of a stored result; returns the stored rows.

    The rows go to a folder beside ``path`` first and take its place by two
    renames: a refresh that fails leaves the old table as it was, and ``df`` may
    read ``path`` itself. Between the renames readers see no table for a moment;
    on object stores a rename is a copy. Shuffle files of the write go with it.
    """
    spark = df.sparkSession
    fresh, old = (f"{path.rstrip('/')}.{side}-{uuid.uuid4().hex}" for side in ("fresh", "old"))
    # hash keys are hexadecimal text, which zstd halves
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(fresh)
    table, fresh, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, fresh, old))
    fs = table.getFileSystem(spark._jsc.hadoopConfiguration())
    held = fs.exists(table)
    if held and not fs.rename(table, old):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(fresh, table):
        if held:
            fs.rename(old, table)
        raise OSError(f"cannot put the refreshed rows at {path}")
    if held:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(path)
