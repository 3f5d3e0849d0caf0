"""One key holding a third of the rows: results stay exact and the plans
combine the hot key map-side instead of sorting it in one task."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_marts.operators import etl as E
from retail_marts.operators import marts as B


def _hot_orders(spark, n=3000):
    base = dt.datetime(2020, 1, 1)
    rows = [(i, 1 if i % 3 == 0 else 2 + i % 97, base + dt.timedelta(days=(i * 37) % 400, hours=i % 5))
            for i in range(n)]
    return spark.createDataFrame(rows, "order_id bigint, customer_id bigint, ordered_at timestamp_ntz")


def test_new_vs_returning_with_a_hot_customer(spark):
    o = _hot_orders(spark)
    got = {r.month: (r.orders, r.new_orders, r.customers, r.new_customers)
           for r in B.new_vs_returning(o).collect()}
    w = Window.partitionBy("customer_id").orderBy("ordered_at", "order_id")
    ref = (o.withColumn("m", F.trunc(F.to_date("ordered_at"), "month"))
            .withColumn("first", (F.row_number().over(w) == 1).cast("int"))
            .groupBy("m").agg(F.count(F.lit(1)), F.sum("first"), F.countDistinct("customer_id"), F.sum("first")))
    assert got == {r[0]: tuple(r[1:]) for r in ref.collect()}


def test_latest_per_key_with_a_hot_key_is_a_partial_aggregate(spark):
    o = _hot_orders(spark)
    got = E.latest_per_key(o, ["customer_id"], ["ordered_at", "order_id"])
    w = Window.partitionBy("customer_id").orderBy(F.col("ordered_at").desc(), F.col("order_id").desc())
    ref = o.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan                      # combined in each map task


def test_session_enables_adaptive_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
