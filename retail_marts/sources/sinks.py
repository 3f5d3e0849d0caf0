"""Sinks: Parquet tables, facts partitioned by month.

``write_fact`` relies on dynamic partition overwrite, so a re-run replaces
exactly the months present in its input and never doubles rows. Rows are
clustered by the partition column with a ``rebalance`` hint: AQE then splits
a month that holds a large share of the rows over several tasks (files) and
merges small months, instead of one file per (task, month) or one task per
month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_fact(df: DataFrame, path: str, by: str | list[str] = "month_key", clustered: bool = False) -> None:
    """Write ``df`` under ``path`` partitioned by ``by``; replaces only the months it holds.
    ``clustered``: the rows are clustered already."""
    cols = [by] if isinstance(by, str) else list(by)
    ((df if clustered else df.hint("rebalance", *cols))
       .write.option("compression", "zstd").mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite a whole (dimension or mart) table."""
    df.write.mode("overwrite").parquet(path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a staging table that a job made, in whatever store it lies."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)
