from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_marts.operators.ranking import global_row_number, ntile_of, running_total


def _skewed(spark, n=3000):
    # a third of the rows share one value; the key breaks the ties
    return spark.range(n).select(F.col("id").alias("k"),
                                 F.when(F.col("id") % 3 == 0, F.lit(7.0))
                                  .otherwise((F.col("id") * 7919 % 1000).cast("double")).alias("v"))


def test_row_number_equals_window_in_any_partitioning(spark):
    base = _skewed(spark)
    ref = {r.k: (r.rn, r.t) for r in base.select(
        "k", F.row_number().over(Window.orderBy("v", "k")).alias("rn"),
        F.ntile(5).over(Window.orderBy("v", "k")).alias("t")).collect()}
    for parts in (1, 4, 16):
        got, n = global_row_number(base.repartition(parts), ["v", "k"], rows_per_bucket=100)
        got = got.withColumn("t", ntile_of(F.col("_rank"), n, 5))
        assert {r.k: (r._rank, r.t) for r in got.collect()} == ref


def test_hot_value_is_spread_over_buckets(spark):
    base = _skewed(spark)
    got, _ = running_total(base, ["v", "k"], rows_per_bucket=100)
    # the plan partitions the window by bucket, not into a single partition
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_running_sum_of_values(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(200)], "k int, w int")
    got, _ = running_total(df, ["k"], "w", "cum", rows_per_bucket=17)
    ref = {r.k: r.c for r in df.select("k", F.sum("w").over(
        Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)).alias("c")).collect()}
    assert {r.k: r.cum for r in got.collect()} == ref


def test_ntile_formula_matches_sql_for_small_counts(spark):
    for n in (0, 1, 3, 4, 5, 6, 11, 23):
        df = spark.range(n).withColumnRenamed("id", "k")
        ref = [r.t for r in df.select(F.ntile(5).over(Window.orderBy("k")).alias("t")).orderBy("k").collect()]
        got = [r.t for r in df.select(ntile_of(F.col("k") + 1, n, 5).alias("t")).orderBy("k").collect()]
        assert got == ref, n
