"""Plan shapes the design relies on at scale (checked on the physical plan)."""

import re

import __spark_entry__ as E

from conftest import SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str) -> list[str]:
    return re.findall(r"(\w+)\.parquet\]", plan)


def test_flagship_scans_each_table_once_and_no_dimension(spark):
    plan = _plan(E.queries()["sales_by_month"](spark, SF0001))
    scans = sorted(_scans(plan))
    assert scans == ["lineitem", "orders"], scans
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan


def test_unused_lookups_are_removed_but_used_ones_kept(spark):
    kpis = _scans(_plan(E.queries()["sales_kpis"](spark, SF0001)))
    assert "customer" not in kpis and "part" not in kpis
    fact = _scans(_plan(E.queries()["fact_sales"](spark, SF0001)))
    assert {"customer", "part", "supplier"} <= set(fact)


def test_latest_per_key_and_first_orders_use_aggregates_not_windows(spark):
    assert "Window" not in _plan(E.queries()["latest_per_key"](spark, SF0001))
    plan = _plan(E.queries()["new_vs_returning"](spark, SF0001))
    assert _scans(plan) == ["orders"]                 # one scan of the orders
    # the only window runs above the (month, customer) aggregate
    window_part = plan.split("Window")[1]
    assert "partial_count" in window_part and "partial_min" in window_part


def test_top_n_per_group_is_limited_before_the_shuffle(spark):
    plan = _plan(E.queries()["top_products_by_brand"](spark, SF0001))
    assert "WindowGroupLimit" in plan


def test_written_fact_is_pruned_by_month(spark, tmp_out):
    from pyspark.sql import functions as F
    from retail_marts.plans.warehouse import load
    load(spark, SF0001, tmp_out)
    df = spark.read.parquet(f"{tmp_out}/fact_sales").filter(F.col("month_key") == 199601)
    plan = _plan(df.select("net_amount"))
    assert "PartitionFilters: [isnotnull(month_key" in plan and "(month_key#" in plan
    assert df.count() > 0


def test_loaded_lines_are_clustered_before_their_keys_are_made(spark, tmp_path):
    """The shuffle by month carries no hashed key; an unknown customer still gets the unknown member."""
    from pyspark.sql import functions as F
    from retail_marts.plans.warehouse import Warehouse, _loaded_sales, _staged_lines
    w = Warehouse(spark, SF0001, lookups=False)
    w.dim_customer = w.dim_customer.where("customer_id % 3 <> 0")
    sales = _loaded_sales(_staged_lines(w, str(tmp_path / "staged"))[0])
    above, below = sales._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
    assert above.count("sha2") >= 3 and "sha2" not in below and "customer_key" not in below
    assert sales.where((F.col("customer_key") == "-1") != (F.col("customer_id") % 3 == 0)).count() == 0
    assert sales.where("customer_key = '-1'").count() > 0


def test_fact_sales_shuffles_lines_once(spark):
    """Broadcasts by size are off, as for dimensions of any size: lines meet orders by shuffle, keys that are missing by broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()["fact_sales"](spark, SF0001))
        assert len(re.findall(r"SortMergeJoin.*Inner", plan)) == 1 and "approx_top_k" not in plan
        assert not re.search(r"SortMergeJoin \[_?(customer|product|seller)_id.*LeftOuter", plan) and len(re.findall(r"BroadcastHashJoin.*LeftOuter", plan)) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
