"""Helpers the operators share: folds, scratch tables, labelled samples."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.session import checkpoint_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text (fold 0)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """A query's shuffles are deleted with its end in here: for rounds whose shuffles are read once."""
    had = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, had)


class Scratch:
    """Tables of one run in the shared folder of ``spark.checkpoint.dir``. Each
    write gets a folder of its own and is read back, which cuts the lineage: a
    lost executor costs a re-read, not a recomputation. ``drop`` deletes tables
    that no later step reads, ``close`` all but those a lazy result still reads;
    those go when the Python process ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        self._tables: list[tuple[DataFrame, str]] = []
        atexit.register(self._end)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:6]}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._tables.append((out, path))
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete the tables that ``put`` returned as ``frames``; other frames are left alone."""
        for i in [i for i, (df, _) in enumerate(self._tables) if any(df is f for f in frames)][::-1]:
            self._delete(self._tables.pop(i)[1])

    def close(self, *keep: DataFrame) -> None:
        """Delete every table of the run but those in ``keep``."""
        self.drop(*[df for df, _ in self._tables if not any(df is k for k in keep)])

    def _delete(self, path: str) -> None:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def _end(self) -> None:
        if self.spark.sparkContext._jsc is not None:  # the session still runs
            self._delete(self.root)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
