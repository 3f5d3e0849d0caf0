import datetime as dt
from decimal import Decimal as D
import hashlib

from pyspark.sql import functions as F

from retail_marts.functions.columns import dim_key
from retail_marts.operators import warehouse as W

from fixtures import LINES, LINES_SCHEMA, ORDERS, ORDERS_SCHEMA, PAYMENTS, PAYMENTS_SCHEMA


def _tpch(spark):
    """The hand rows under the source column names the facts read."""
    o = spark.createDataFrame(ORDERS, ORDERS_SCHEMA).select(
        F.col("order_id").alias("o_orderkey"), F.col("customer_id").alias("o_custkey"),
        F.col("status").alias("o_orderstatus"), F.lit(0.0).alias("o_totalprice"),
        F.col("ordered_at").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    li = spark.createDataFrame(LINES, LINES_SCHEMA).select(
        F.col("order_id").alias("l_orderkey"), F.col("product_id").alias("l_partkey"),
        F.col("seller_id").alias("l_suppkey"), F.col("line_no").alias("l_linenumber"),
        F.col("qty").cast("double").alias("l_quantity"), F.col("price").cast("double").alias("l_extendedprice"),
        F.col("discount").cast("double").alias("l_discount"), F.lit(0.1).alias("l_tax"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit(dt.datetime(2020, 2, 1)).cast("timestamp_ntz").alias("l_shipdate"))
    return li, o


def test_dim_key_hash_and_null_guard(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (1, None)], "x bigint, y string")
    got = [r.k for r in df.select(dim_key("x", "y").alias("k")).collect()]
    assert got[0] == hashlib.sha256(b"1|a").hexdigest()
    assert got[1] == "-1" and got[2] == "-1"
    one = spark.createDataFrame([(42,)], "x bigint").select(dim_key("x").alias("k")).first().k
    assert one == hashlib.sha256(b"42").hexdigest()


def test_dim_date_calendar_fields(spark):
    d = {r.date: r for r in W.dim_date_between(spark, "2020-12-28", "2021-01-04").collect()}
    assert len(d) == 8
    mon = d[dt.date(2020, 12, 28)]
    assert (mon.weekday, mon.iso_week, mon.quarter, mon.date_key) == (0, 53, 4, 20201228)
    ny = d[dt.date(2021, 1, 1)]
    assert (ny.weekday, ny.iso_week, ny.month_start, ny.month_key) == (4, 53, dt.date(2021, 1, 1), 202101)


def test_lookup_keeps_rows_and_maps_unknown(spark):
    orders = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    dim = spark.createDataFrame([(10,), (11,), (12,), (10,)], "customer_id bigint") \
               .withColumn("customer_key", dim_key("customer_id"))
    out = W.lookup(orders, dim, {"customer_id": "customer_id"}, "customer_key")
    assert out.count() == orders.count()
    keys = {r.order_id: r.customer_key for r in out.collect()}
    assert keys[3] == "-1" and keys[4] == "-1"
    assert keys[1] == hashlib.sha256(b"10").hexdigest()


def test_fact_sales_exact_measures(spark):
    li, o = _tpch(spark)
    s = W.fact_sales(li, o)
    rows = {(r.order_id, r.line_no): r for r in s.collect()}
    assert s.count() == 7                       # line of missing order 8 dropped, repeated row kept
    assert rows[(1, 1)].net_amount == D("100.00")          # discount 0
    assert rows[(1, 2)].net_amount == D("0.00")            # discount 1
    r = rows[(2, 1)]
    assert (r.discount_amount, r.net_amount, r.tax_amount) == (D("1.01"), D("9.04"), D("0.90"))
    assert dict(s.dtypes)["net_amount"] == "decimal(18,2)"
    assert rows[(6, 1)].month_key == 202012 and rows[(6, 1)].order_date_key == 20201231


def test_fact_sales_lookup_unknown_members(spark):
    li, o = _tpch(spark)
    dc = spark.createDataFrame([(10,), (11,), (12,)], "customer_id bigint") \
              .withColumn("customer_key", dim_key("customer_id"))
    s = W.fact_sales(li, o, dim_customer=dc)
    keys = {r.order_id: r.customer_key for r in s.collect()}
    assert keys[3] == "-1"
    assert s.count() == 7


def test_drill_across_does_not_fan_out(spark):
    li, o = _tpch(spark)
    sales = W.fact_sales(li, o)
    pay = spark.createDataFrame(PAYMENTS, PAYMENTS_SCHEMA)
    out = W.drill_across([(sales, [F.sum("net_amount").alias("net"), F.count(F.lit(1)).alias("lines")]),
                          (pay, [F.sum("amount").alias("paid"), F.count(F.lit(1)).alias("payments")])],
                         ["order_id"])
    r = {x.order_id: x for x in out.collect()}
    assert (r[1].net, r[1].lines, r[1].paid, r[1].payments) == (D("100.00"), 2, D("100.00"), 2)
    assert set(r) == {1, 2, 3, 5, 6}                 # order 7 has neither lines nor payments
    # a key present in one process only shows nulls for the other
    only_sales = W.drill_across([(sales, [F.count(F.lit(1)).alias("lines")]),
                                 (pay.filter("order_id <> 5"), [F.count(F.lit(1)).alias("payments")])],
                                ["order_id"])
    r5 = only_sales.filter("order_id = 5").first()
    assert r5.lines == 1 and r5.payments is None
