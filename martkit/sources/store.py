"""Versioned Parquet tables for loaders that replace or append rows.

Each write goes to a new folder ``v=<number>-<kind>-<token>``; Spark's
``_SUCCESS`` file, created when the write job commits, makes it visible. A
``full`` folder replaces the table, an ``add`` folder extends it. Readers never
see half a write, a table can be read and republished in one job, and a token
that is already stored (a business date, a stream batch id) is skipped, so
replays are harmless. One writer per table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class TableStore:
    def __init__(self, spark: SparkSession, base: str, schema: T.StructType):
        self.spark = spark
        self.base = base.rstrip("/")
        self.schema = schema

    def _versions(self) -> list[tuple[int, str, str, str]]:
        """Committed writes as (number, kind, token, path), oldest first."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.base)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            path = status.getPath()
            match = re.fullmatch(r"v=(\d+)-(full|add)-(.*)", path.getName())
            if match and fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
                found.append((int(match[1]), match[2], match[3], path.toString()))
        return sorted(found)

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def exists(self) -> bool:
        return bool(self._versions())

    def has(self, token: str) -> bool:
        return any(done == _safe(token) for _, _, done, _ in self._versions())

    def read(self) -> DataFrame:
        """Current rows; an empty frame before the first write."""
        paths: list[str] = []
        for _, kind, _, path in self._versions():
            paths = [path] if kind == "full" else [*paths, path]
        return self._read(paths)

    def written(self, token: str) -> DataFrame:
        """Rows stored under one token."""
        return self._read([p for _, _, done, p in self._versions() if done == _safe(token)])

    def _write(self, df: DataFrame, kind: str, token: str) -> bool:
        versions = self._versions()
        if any(done == _safe(token) for _, _, done, _ in versions):
            return False
        number = versions[-1][0] + 1 if versions else 1
        columns = [f.name for f in self.schema.fields]
        target = f"{self.base}/v={number:08d}-{kind}-{_safe(token)}"
        df.select(*columns).write.mode("overwrite").parquet(target)
        return True

    def publish(self, df: DataFrame, token: str) -> bool:
        """Replace the table by ``df`` unless ``token`` is already stored."""
        return self._write(df, "full", token)

    def append(self, df: DataFrame, token: str) -> bool:
        """Add the rows of ``df`` unless ``token`` is already stored."""
        return self._write(df, "add", token)

    def change(self, step: Callable[[DataFrame], DataFrame], token: str) -> bool:
        """Publish ``step(current)``; nothing is computed for a token already stored."""
        return False if self.has(token) else self.publish(step(self.read()), token)


def _safe(token: str) -> str:
    """Name of a folder; different tokens have different names."""
    return re.sub(r"[^A-Za-z0-9.-]", lambda m: f"_{m[0].encode().hex()}_", token)
