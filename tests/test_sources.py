import os

import pytest
from pyspark.sql import functions as F

from retail_marts.sources import SchemaMismatch, read_table, write_fact
from retail_marts.sources.tables import SCHEMAS, check_schema

from conftest import SF0001


def test_read_table_checks_and_drops_extra(spark):
    df = read_table(spark, SF0001, "orders")
    assert df.columns == [f.name for f in SCHEMAS["orders"].fields]
    extra = df.withColumn("extra", F.lit(1))
    assert check_schema(extra, SCHEMAS["orders"]).columns == df.columns


def test_read_table_missing_column_raises(spark):
    df = read_table(spark, SF0001, "orders").drop("o_custkey")
    with pytest.raises(SchemaMismatch, match="missing column o_custkey"):
        check_schema(df, SCHEMAS["orders"], "orders")


def test_read_table_changed_type_raises(spark):
    df = read_table(spark, SF0001, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    with pytest.raises(SchemaMismatch, match="o_totalprice"):
        check_schema(df, SCHEMAS["orders"], "orders")


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = read_table(spark, SF0001, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_write_fact_twice_equals_once_and_replaces_only_its_months(spark, tmp_out):
    rows = [(1, 202001, 1.0), (2, 202001, 2.0), (3, 202002, 3.0)]
    df = spark.createDataFrame(rows, "id int, month_key int, v double")
    path = os.path.join(tmp_out, "fact")
    write_fact(df, path)
    write_fact(df, path)
    back = spark.read.parquet(path)
    assert back.count() == 3
    # reload February only with a changed row: January stays untouched
    write_fact(spark.createDataFrame([(4, 202002, 4.0)], "id int, month_key int, v double"), path)
    got = sorted((r.id, r.month_key) for r in spark.read.parquet(path).collect())
    assert got == [(1, 202001), (2, 202001), (4, 202002)]
