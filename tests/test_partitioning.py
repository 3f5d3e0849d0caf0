"""The same rows in any partitioning give the same result."""

import pytest

import __spark_entry__ as E

from conftest import SF0001

import importlib.util
import os

_spec = importlib.util.spec_from_file_location(
    "oracle_check", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "oracle_check.py"))
OC = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(OC)

NAMES = ["sales_by_month", "sales_kpis", "latest_per_key", "new_vs_returning", "rfm_scores",
         "assign_segments", "evaluate_length", "payment_stats", "drill_across", "top_products_by_brand",
         "sales_rollup"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_in_any_partitioning(spark, name):
    results = []
    for parts, split in (("1", str(128 * 1024 * 1024)), ("16", "4096")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            df = E.queries()[name](spark, SF0001)
            results.append(OC.rows_of(df.columns, [tuple(r) for r in df.collect()]))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert results[0] == results[1]
