"""Every SQL-expressible query equals its DuckDB oracle (sf0.001, whole tables)."""

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as E
from retail_marts.plans.warehouse import load

from conftest import SF0001

_spec = importlib.util.spec_from_file_location(
    "oracle_check", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "oracle_check.py"))
OC = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(OC)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in OC.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_a_callable_and_sql_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 40


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    a = OC.rows_of(df.columns, [tuple(r) for r in df.collect()])
    b = OC.rows_of(dcols, res.fetchall())
    assert a == b


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - {"train_models", "choose_k"}))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF0001).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "net_revenue", "orders", "prev_net_revenue", "mom_change"]


def test_load_writes_warehouse_and_balances(spark, tmp_out):
    rec = load(spark, SF0001, tmp_out).collect()
    assert len(rec) == 1 and rec[0].balanced
    assert rec[0].loaded_rows == rec[0].accepted_rows == spark.read.parquet(f"{SF0001}/lineitem.parquet").count()
    # loading twice gives the same rows, not twice the rows
    load(spark, SF0001, tmp_out)
    assert spark.read.parquet(f"{tmp_out}/fact_sales").count() == rec[0].loaded_rows
    assert spark.read.parquet(f"{tmp_out}/dim_customer").filter("customer_key = '-1'").count() == 1


def test_load_maps_unknown_customers_to_unknown_member(spark, tmp_out):
    """A customer missing from the dimension must not leave a dangling key."""
    import shutil
    src = os.path.join(tmp_out, "src")
    os.makedirs(src)
    for t in ("region", "nation", "supplier", "part", "orders", "lineitem", "events", "documents", "labels"):
        shutil.copytree(f"{SF0001}/{t}.parquet", f"{src}/{t}.parquet") if os.path.isdir(
            f"{SF0001}/{t}.parquet") else shutil.copy(f"{SF0001}/{t}.parquet", f"{src}/{t}.parquet")
    cust = spark.read.parquet(f"{SF0001}/customer.parquet")
    first = cust.agg({"c_custkey": "min"}).first()[0]
    cust.filter(f"c_custkey <> {first}").write.parquet(f"{src}/customer.parquet")
    load(spark, src, os.path.join(tmp_out, "wh"))
    sales = spark.read.parquet(os.path.join(tmp_out, "wh", "fact_sales"))
    dim = spark.read.parquet(os.path.join(tmp_out, "wh", "dim_customer"))
    dangling = sales.join(dim, "customer_key", "left_anti").count()
    assert dangling == 0
    assert sales.filter(f"customer_id = {first}").filter("customer_key = '-1'").count() > 0
