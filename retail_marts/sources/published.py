"""A published warehouse - tables that change version by version.

A load writes its tables beside the ones that are read, each into a folder of
its own run, and then *publishes* a manifest: one row per table, or per month of
a fact, with the folder that holds it. A version counts once its manifest's
write has committed (``_SUCCESS``), so a load that is killed at any time leaves
the version before it readable, and a reader that has opened a version keeps
reading the files of that version.

A fact's months that a load doesn't touch are taken over from the version
before; months it holds are replaced as a whole, so loading twice gives the rows
once. Nothing is overwritten in place. ``remove_old`` deletes folders that no
kept version names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.sources.sinks import remove_table

MANIFEST = "table_name string, month_key int, path string"


class NotPublished(FileNotFoundError):
    """The folder holds no published version, or none of the table."""


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    out = []
    for name in _folders(spark, f"{root}/manifest"):
        fs, done = _fs(spark, f"{root}/manifest/{name}/_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and fs.exists(done):
            out.append(int(name[1:]))
    return sorted(out)


def _manifest(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest/v{version:08d}")


class Publication:
    """One run of a load into ``root``. ``add_table`` and ``add_fact`` write; ``publish`` makes all of it visible at once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), uuid.uuid4().hex[:12]
        self._rows: list[tuple[str, int | None, str]] = []
        self._facts: set[str] = set()

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}/run={self.run}"

    def add_table(self, df: DataFrame, name: str) -> DataFrame:
        """Write a whole table (a dimension or a mart)."""
        df.write.parquet(self.folder(name))
        self._rows.append((name, None, self.folder(name)))
        return self.spark.read.schema(df.schema).parquet(self.folder(name))

    def add_fact(self, df: DataFrame, name: str, by: str = "month_key", clustered: bool = False) -> DataFrame:
        """Write the months that ``df`` holds. Rows are clustered by month with a rebalance hint (``clustered``: they
        are already), so AQE splits a large month over several files and merges small ones. Zstandard, as
        hashed keys hold half a byte a character, which Snappy doesn't see."""
        placed = df if clustered else df.hint("rebalance", by)
        placed.write.option("compression", "zstd").partitionBy(by).parquet(self.folder(name))
        self._facts.add(name)
        for part in _folders(self.spark, self.folder(name)):
            if part.startswith(f"{by}="):
                value = part.split("=", 1)[1]
                month = None if value.startswith("__HIVE_DEFAULT") else int(value)
                self._rows.append((name, month, f"{self.folder(name)}/{part}"))
        return self.spark.read.schema(df.schema).parquet(self.folder(name))

    def publish(self) -> int:
        """Make this run the current version: its tables and months, and what else the last version held."""
        seen = versions(self.spark, self.root)
        rows = list(self._rows)
        if seen:
            new = {(name, month) for name, month, _ in rows}
            whole = {name for name, _, _ in rows} - self._facts
            rows += [tuple(r) for r in _manifest(self.spark, self.root, seen[-1]).collect()  # a row a table and month
                     if (r.table_name, r.month_key) not in new and r.table_name not in whole]
        version = seen[-1] + 1 if seen else 1
        taken = [int(v[1:]) for v in _folders(self.spark, f"{self.root}/manifest") if v[1:].isdigit()]
        version = max([version, *[v + 1 for v in taken]])  # a killed publication's number isn't used again
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(f"{self.root}/manifest/v{version:08d}")
        return version


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table or fact of a published version (the last by default). A fact's ``month_key`` is a partition column."""
    root = root.rstrip("/")
    seen = versions(spark, root)
    if not seen or (version is not None and version not in seen):
        raise NotPublished(f"{root}: no published version" + (f" {version}" if version is not None else ""))
    rows = _manifest(spark, root, version or seen[-1]).where(F.col("table_name") == name).orderBy("month_key").collect()
    if not rows:
        raise NotPublished(f"{root}: version {version or seen[-1]} has no table {name}")
    paths = [r.path for r in rows]
    if all("month_key=" not in p for p in paths):
        return spark.read.parquet(*paths)
    return spark.read.option("basePath", f"{root}/{name}").option("mergeSchema", "false").parquet(*paths).drop("run")


def remove_old(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the last ``keep`` versions and the folders that only they name; the versions deleted."""
    root = root.rstrip("/")
    seen = versions(spark, root)
    old, kept = seen[:-keep], seen[-keep:]
    used = {r.path for v in kept for r in _manifest(spark, root, v).collect()}
    gone = {r.path for v in old for r in _manifest(spark, root, v).collect()} - used
    for path in sorted(gone):
        remove_table(spark, path)
    for v in old:
        remove_table(spark, f"{root}/manifest/v{v:08d}")
    return old
