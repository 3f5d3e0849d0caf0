"""Read a source table and check it against its declared schema.

A missing column or a changed type raises ``SchemaMismatch``; columns that
are not declared are dropped, so later projections prune the Parquet scan
to the columns a job really uses (``ReadSchema`` in ``explain``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Declared source schemas (the driver tables; see FIXTURES.md part B).
SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                        ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                    ("p_retailprice", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                      ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D),
                      ("props", S)),
    "documents": _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
}


class SchemaMismatch(ValueError):
    """A source table lacks a declared column or carries it with another type."""


def check_schema(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Compare ``df`` with ``schema``; return only the declared columns, in order."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: declared {f.dataType.simpleString()}, "
                            f"found {have[f.name].simpleString()}")
    if problems:
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))
    return df.select(*[f.name for f in schema.fields])


def read_table(spark: SparkSession, directory: str, name: str,
               schema: T.StructType | None = None) -> DataFrame:
    """Read ``<directory>/<name>.parquet`` (file or folder) and check its schema."""
    schema = schema if schema is not None else SCHEMAS[name]
    path = os.path.join(directory, f"{name}.parquet")
    return check_schema(spark.read.parquet(path), schema, name)


def read_tables(spark: SparkSession, directory: str, *names: str) -> dict[str, DataFrame]:
    return {n: read_table(spark, directory, n) for n in names}


def column_totals(df: DataFrame, name: str) -> DataFrame:
    """One line per column of ``df``: table_name, column_name, row_count, null_count and ``total``, the exact
    sum of a number (to four decimals), of the characters of a text or of the days since 1970 of a time.

    A single pass: one aggregate row is turned into lines, the data isn't copied per column. Other
    types are counted only (total 0).
    """
    measure = {"string": F.length, "timestamp_ntz": lambda c: F.unix_date(F.to_date(c)), "date": F.unix_date}
    aggs, lines = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(df.schema.fields):
        kind = f.dataType.simpleString()
        value = measure[kind](F.col(f.name)) if kind in measure else F.col(f.name) if isinstance(f.dataType, T.NumericType) else F.lit(0)
        aggs += [F.count(F.col(f.name)).alias(f"c{i}"), F.coalesce(F.sum(value.cast("decimal(28,4)")), F.lit(0)).cast("decimal(38,4)").alias(f"t{i}")]
        lines.append(F.struct(F.lit(f.name).alias("column_name"), F.col("n").alias("row_count"),
                              (F.col("n") - F.col(f"c{i}")).alias("null_count"), F.col(f"t{i}").alias("total")))
    return df.agg(*aggs).select(F.lit(name).alias("table_name"), F.inline(F.array(*lines)))
