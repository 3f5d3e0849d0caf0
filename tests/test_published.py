"""The published warehouse: equal to the source star, versioned, pruned by month, safe from a load that dies."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from retail_marts.operators import marts as B
from retail_marts.plans import catalog
from retail_marts.plans.warehouse import Warehouse, load_version
from retail_marts.sources import published as P

SRC = "/root/testdata/sf0.001"
MARTS = ["sales_by_month", "sales_kpis", "sales_ytd", "sales_rollup", "sales_cube", "top_products", "top_products_by_brand", "new_vs_returning", "repeat_rate",
         "customers_by", "payments_by_type", "payments_pivot", "payment_stats", "rating_distribution", "satisfaction_by"]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    r = str(tmp_path_factory.mktemp("published"))
    assert load_version(spark, SRC, r).first().balanced
    return r


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("name", MARTS)
def test_every_mart_is_equal_on_both_sources(spark, root, name, monkeypatch):
    want = rows(catalog.QUERIES[name](spark, SRC))
    monkeypatch.setattr(catalog, "wh", lambda s, d: Warehouse.from_loaded(s, root))
    assert rows(catalog.QUERIES[name](spark, SRC)) == want


def test_month_filter_prunes_and_no_source_table_is_read(spark, root):
    wh = Warehouse.from_loaded(spark, root)
    plan = B.sales_by_month(wh.sales.where("month_key = 199501"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan and "Join" not in plan


def test_date_dimension_prunes_months_at_run_time(spark, root):
    wh = Warehouse.from_loaded(spark, root)
    months = wh.dim_date.where("year = 1995 AND quarter = 2").select("month_key").distinct()
    plan = wh.sales.join(months, "month_key").groupBy("month_key").count()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def _source(spark, folder, lines):
    os.makedirs(folder)
    for name in os.listdir(SRC):
        if name != "lineitem.parquet":
            (shutil.copytree if os.path.isdir(f"{SRC}/{name}") else shutil.copy)(f"{SRC}/{name}", f"{folder}/{name}")
    lines.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_loaded_sales_are_the_marts_sales_on_dirty_input(spark, tmp_out):
    li = spark.read.parquet(f"{SRC}/lineitem.parquet")
    dirty = (li.withColumn("l_quantity", F.when(F.col("l_orderkey") % 100 == 1, F.lit(-1.0)).otherwise(F.col("l_quantity")))
             .withColumn("l_partkey", F.when(F.col("l_orderkey") % 100 == 3, 10**9).when(F.col("l_orderkey") % 100 == 4, None).otherwise(F.col("l_partkey")))
             .withColumn("l_orderkey", F.when(F.col("l_orderkey") % 100 != 2, F.col("l_orderkey"))))
    src = _source(spark, f"{tmp_out}/src", dirty)
    again = spark.read.parquet(f"{src}/orders.parquet").limit(50)  # orders listed twice, the later one counts
    twice = spark.read.parquet(f"{src}/orders.parquet").unionByName(again.withColumn("o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")))
    twice.write.parquet(f"{tmp_out}/orders")
    os.remove(f"{src}/orders.parquet") if os.path.isfile(f"{src}/orders.parquet") else shutil.rmtree(f"{src}/orders.parquet")
    os.rename(f"{tmp_out}/orders", f"{src}/orders.parquet")
    r = load_version(spark, src, f"{tmp_out}/wh").first()
    assert r.balanced and r.rejected_rows > 0
    lazy, loaded = Warehouse(spark, src, checked=True).sales, Warehouse.from_loaded(spark, f"{tmp_out}/wh").sales
    assert rows(lazy) == rows(loaded.select(lazy.columns)) and lazy.count() == r.accepted_rows
    assert rows(Warehouse(spark, src).orders) != rows(Warehouse.from_loaded(spark, f"{tmp_out}/wh").orders)  # repeated orders count once in the load


def test_versions_replace_months_and_survive_a_dead_load(spark, tmp_out, monkeypatch):
    one = f"{tmp_out}/wh"
    load_version(spark, SRC, one)
    n = Warehouse.from_loaded(spark, one).sales.count()
    first = Warehouse.from_loaded(spark, one, 1).sales
    load_version(spark, SRC, one)
    assert P.versions(spark, one) == [1, 2] and Warehouse.from_loaded(spark, one).sales.count() == n  # twice is once
    with monkeypatch.context() as m:  # killed after the tables, before the manifest
        m.setattr(P.Publication, "publish", lambda self: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            load_version(spark, SRC, one)
    os.makedirs(f"{one}/manifest/v00000003")  # and killed while writing the manifest: no _SUCCESS
    assert P.versions(spark, one) == [1, 2] and Warehouse.from_loaded(spark, one).sales.count() == n
    # a later load of one month replaces that month only
    li = spark.read.parquet(f"{SRC}/lineitem.parquet")
    month = Warehouse.from_loaded(spark, one).sales.agg(F.min("month_key")).first()[0]
    keys = Warehouse.from_loaded(spark, one).sales.where(F.col("month_key") == month).select(F.col("order_id").alias("l_orderkey")).distinct()
    part = li.join(keys, "l_orderkey", "left_semi").where("l_linenumber = 1").select(li.columns)
    k = load_version(spark, _source(spark, f"{tmp_out}/src", part), one).first().accepted_rows
    got = Warehouse.from_loaded(spark, one).sales
    assert P.versions(spark, one) == [1, 2, 4]
    assert got.where(F.col("month_key") == month).count() == k and got.where(F.col("month_key") != month).count() == first.where(F.col("month_key") != month).count()
    assert P.remove_old(spark, one, keep=1) == [1, 2]
    assert P.versions(spark, one) == [4] and Warehouse.from_loaded(spark, one).sales.count() == got.count()
    with pytest.raises(P.NotPublished):
        P.read_published(spark, one, "fact_sales", 2)
    with pytest.raises(P.NotPublished):
        P.read_published(spark, f"{tmp_out}/nothing", "fact_sales")
