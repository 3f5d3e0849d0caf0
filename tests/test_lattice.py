"""Stored aggregates answer a request as the base fact does; cubes and drill-across from small results."""

import pytest
from pyspark.sql import functions as F

from retail_marts.operators import marts as B
from retail_marts.operators import warehouse as W
from retail_marts.plans import star
from retail_marts.plans.lattice import Lattice
from retail_marts.plans.star import Dimension, Measure, StarModel


@pytest.fixture(scope="module")
def model(spark):
    fact = spark.range(4000).select(
        "id", F.when(F.col("id") % 11 > 0, F.col("id") % 40).alias("shop_id"), (F.col("id") % 5).alias("kind"),
        F.when(F.col("id") % 13 > 0, (F.col("id") * 7 % 1000).cast("decimal(18,2)")).alias("amount"), (F.col("id") % 700).alias("order_id"))
    shops = spark.range(30).select(F.col("id").alias("shop_key"), (F.col("id") % 6).alias("city"), (F.col("id") % 2).alias("land"))
    return StarModel(fact, {"shop": Dimension(shops, "shop_id", "shop_key")},
                     {"sales": Measure("count"), "revenue": Measure("sum", "amount"), "mean": Measure("mean", "amount"), "orders": Measure("distinct", "order_id")},
                     {"kind": (None, lambda: F.col("kind")), "city": ("shop", lambda: F.col("city")), "land": ("shop", lambda: F.col("land"))})


@pytest.fixture(scope="module")
def lattice(spark, model, tmp_path_factory):
    return Lattice.build(model, str(tmp_path_factory.mktemp("lattice")), [["city", "land", "kind"], ["land", "kind"], ["land"], ["kind"]])


REQUESTS = [
    (["sales", "revenue", "mean"], ["land"], [], ("land",)),
    (["sales"], [], [("kind", "in", [1, 2])], ("kind",)),
    (["revenue", "mean"], ["land"], [("kind", "!=", 3)], ("land", "kind")),
    (["mean"], ["city"], [("land", "=", 1)], ("city", "land", "kind")),
    (["sales", "revenue"], ["kind"], [("city", "is null")], ("city", "land", "kind")),
    (["sales"], [], [], ("land",)),
    (["orders", "sales"], ["land"], [], None),
]


@pytest.mark.parametrize("measures,by,where,reads", REQUESTS)
def test_answers_equal_the_base_fact(model, lattice, measures, by, where, reads):
    source = lattice.source(measures, by, where)
    assert (source and source.attributes) == reads
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(lattice.slice(measures, by, where)) == rows(star.slice(model, measures, by, where))
    # and both equal a plain join and aggregate of all rows
    wide = model.fact.join(model.dims["shop"].df, F.col("shop_id") == F.col("shop_key"), "left")
    for a, op, *v in where:
        wide = wide.filter(star._OPS[op](F.col(a), v[0] if v else None))
    assert rows(star.slice(model, measures, by, where)) == rows(wide.groupBy(*by).agg(*[model.measures[m]().alias(m) for m in measures]))


def test_unknown_names_raise(lattice):
    for args in ((["nothing"], []), (["sales"], ["nothing"]), (["sales"], [], [("kind", "like", 1)]), (["sales"], [], [], [("kind", "asc")])):
        with pytest.raises(star.UnknownName):
            lattice.slice(*args)


def test_additive_slices_sum_by_key_before_the_join(model):
    plan = star.slice(model, ["revenue"], ["city"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate [shop_id")  # below the join


def test_cube_counts_distinct_orders_from_cells(spark):
    sales = spark.range(9000).select((F.col("id") % 1000 + F.when(F.col("id") % 2 == 0, 70_000).otherwise(0)).alias("order_id"), (F.col("id") % 3).alias("a"),
                                     F.when(F.col("id") % 7 > 0, F.col("id") % 4).alias("b"), F.col("id").cast("decimal(18,2)").alias("net_amount"))
    got = B.sales_cube_orders(sales, ["a", "b"])
    want = sales.cube("a", "b").agg(F.sum("net_amount").cast("decimal(18,2)").alias("net_revenue"), F.count(F.lit(1)).alias("lines"), F.countDistinct("order_id").alias("orders"),
                                    F.grouping("a").cast("int").alias("g_a"), F.grouping("b").cast("int").alias("g_b"))
    cols = ["a", "b", "net_revenue", "lines", "orders", "g_a", "g_b"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
    for df in (got, B.sales_cube(sales, ["a", "b"]), B.sales_rollup(sales, ["a", "b"])):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" in plan[plan.index("Expand"):]  # Expand stands above the first aggregate
        assert plan.count("Range (") == 1


def test_drill_across_is_one_aggregate_of_small_results(spark):
    a = spark.createDataFrame([(None, 1), (1, 2), (1, 3)], "k int, x int")
    out = W.drill_across([(a, [F.sum("x").alias("s")]), (a, [F.count("*").alias("n")]), (a.where("k = 1"), [F.max("x").alias("m")])], ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, 1, 1, None), (1, 5, 2, 3)], key=str)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError):
        W.drill_across([(a, [F.sum("x").alias("s")]), (a.withColumn("k", F.col("k").cast("string")), [F.count("*").alias("n")])], ["k"])
    with pytest.raises(ValueError):
        W.drill_across([(a, [F.sum("x").alias("s")]), (a, [F.count("*").alias("s")])], ["k"])
