"""Dirty inputs and edge cases: reloads, ranking with nulls, null keys, undated rows, repeated members."""

import os
import shutil
from decimal import Decimal as D

from pyspark.sql import functions as F

from retail_marts.operators import marts, ranking, warehouse as W
from retail_marts.plans.warehouse import load

SRC = "/root/testdata/sf0.001"


def _source(spark, folder, lines):
    for name in os.listdir(SRC):
        if name != "lineitem.parquet":
            shutil.copy(f"{SRC}/{name}", folder)
    lines.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_dirty_load_then_clean_reload_then_one_month(spark, tmp_path):
    li = spark.read.parquet(f"{SRC}/lineitem.parquet")
    bad = li.withColumn("l_quantity", F.when(F.col("l_orderkey") % 100 == 1, F.lit(-1).cast(li.schema["l_quantity"].dataType))
                        .otherwise(F.col("l_quantity"))) \
            .withColumn("l_orderkey", F.when(F.col("l_orderkey") % 100 != 2, F.col("l_orderkey")))
    n_bad, n = li.filter("l_orderkey % 100 IN (1, 2)").count(), li.count()
    for d in ("dirty", "clean", "month"):
        (tmp_path / d).mkdir()
    dst = str(tmp_path / "wh")
    r = load(spark, _source(spark, tmp_path / "dirty", bad), dst).first()
    assert n_bad > 0 and (r.accepted_rows, r.rejected_rows, r.balanced) == (n - n_bad, n_bad, True)
    assert spark.read.parquet(f"{dst}/fact_sales").filter("month_key IS NULL").count() == 0

    r = load(spark, _source(spark, tmp_path / "clean", li), dst).first()
    assert (r.accepted_rows, r.rejected_rows, r.balanced) == (n, 0, True)
    assert spark.read.parquet(f"{dst}/rejects_lineitem").count() == 0
    assert not [x for x in os.listdir(dst) if x.startswith("_checked")]
    assert {x.payment_type for x in spark.read.parquet(f"{dst}/fact_payments").select("payment_type").distinct().collect()} == {"PURCHASE"}

    orders = spark.read.parquet(f"{SRC}/orders.parquet")
    first = orders.agg(F.date_format(F.min("o_orderdate"), "yyyyMM")).first()[0]
    one = orders.filter(F.date_format("o_orderdate", "yyyyMM") == first).select(F.col("o_orderkey").alias("l_orderkey"))
    r = load(spark, _source(spark, tmp_path / "month", li.join(one, "l_orderkey", "left_semi").select(li.columns)), dst).first()
    assert r.balanced and 0 < r.accepted_rows < n
    assert spark.read.parquet(f"{dst}/fact_sales").count() == n


def test_percentiles_with_null_groups_and_without_groups(spark):
    df = spark.createDataFrame([(None, D(i)) for i in range(1, 6)] + [("a", D(10)), ("a", D(20)), ("b", None)], "g string, v decimal(18,2)")
    got = {r.g: r.p0 for r in ranking.exact_percentiles(df, ["g"], "v", [0.5], rows_per_bucket=2).collect()}
    assert got == {None: D(3), "a": D(15)}
    whole = ranking.exact_percentiles(df, [], "v", [0.5], rows_per_bucket=2)
    assert [r.p0 for r in whole.collect()] == [D(4)]


def test_running_sum_keeps_the_values_type(spark):
    for kind in ("double", "decimal(10,2)", "int"):
        df = spark.range(30).select("id", F.col("id").cast(kind).alias("v"))
        got, n = ranking.running_total(df, ["id"], "v", rows_per_bucket=4)
        assert n == 30 and [float(r._cum) for r in got.orderBy("id").collect()] == [k * (k + 1) / 2 for k in range(30)]
    got, _ = ranking.running_total(df.limit(0), ["id"], "v")
    assert got.count() == 0


def test_drill_across_null_key_is_one_row(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "k int, x int")
    b = spark.createDataFrame([(None, 5), (2, 6)], "k int, y int")
    out = W.drill_across([(a, [F.sum("x").alias("x")]), (b, [F.sum("y").alias("y")]), (b, [F.count("*").alias("n")])], ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, 1, 5, 1), (1, 2, None, None), (2, None, 6, 1)], key=str)


def test_undated_revenue_stays_in_the_months(spark):
    df = spark.sql("""SELECT * FROM VALUES (1L, CAST(5 AS DECIMAL(18,2)), CAST(NULL AS TIMESTAMP_NTZ)),
        (2L, CAST(10 AS DECIMAL(18,2)), TIMESTAMP_NTZ'2020-01-05 00:00:00'), (3L, CAST(30 AS DECIMAL(18,2)), TIMESTAMP_NTZ'2020-03-05 00:00:00')
        AS t(order_id, net_amount, ordered_at)""")
    got = [(str(r.month) if r.month else None, r.net_revenue, r.prev_net_revenue) for r in marts.sales_by_month(df).orderBy("month").collect()]
    assert got == [(None, D(5), None), ("2020-01-01", D(10), None), ("2020-02-01", D(0), D(10)), ("2020-03-01", D(30), D(0))]


def test_customer_listed_twice_is_one_member(spark):
    c = spark.sql("""SELECT * FROM VALUES (1L, 'a', 0, 'X', CAST(1 AS DOUBLE)), (1L, 'b', 0, 'Y', CAST(2 AS DOUBLE)), (CAST(NULL AS BIGINT), 'z', 0, 'X', CAST(0 AS DOUBLE))
        AS t(c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal)""")
    nation, region = spark.read.parquet(f"{SRC}/nation.parquet"), spark.read.parquet(f"{SRC}/region.parquet")
    rows = W.dim_customer(c, nation, region).collect()
    assert sorted((r.customer_id or 0, r.customer_name) for r in rows if r.customer_key != "-1") == [(1, "b")]
    assert len(rows) == 2
