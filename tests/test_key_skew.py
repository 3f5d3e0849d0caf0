"""Key resolution where one key holds most rows: the result is the plain join's, and the work is spread."""

import pytest
from pyspark.sql import functions as F

from retail_marts.operators import etl as E
from retail_marts.operators import warehouse as W
from retail_marts.operators.skew import HotKeys, heavy_keys, match_keys


def child(spark, n=60_000):
    """Two thirds of the rows on key 1, a sixth null, the rest spread."""
    k = F.when(F.col("id") % 3 != 0, 1).when(F.col("id") % 6 == 0, None).otherwise(F.col("id") % 4999)
    return spark.range(n).select("id", k.cast("bigint").alias("k"), F.when(F.col("id") % 5 > 0, "a").alias("s"))


def parent(spark, hot=True):
    keys = spark.range(2, 5000, 2).union(spark.range(2, 600, 2))  # repeated keys
    return (keys.union(spark.range(1, 2)) if hot else keys).select(F.col("id").alias("p"), F.lit("a").alias("q"), (F.col("id") * 10).alias("v"))


def test_heavy_keys_lists_hot_keys_only(spark):
    assert [(r.item, r.rows >= 40_000) for r in heavy_keys(child(spark), ["k"]).collect()] == [(1, True)]
    assert [r.item for r in heavy_keys(child(spark), ["k", "s"]).collect()] == ['{"k0":1,"k1":"a"}']
    assert heavy_keys(child(spark).limit(0), ["k"]).collect() == []
    with pytest.raises(ValueError):
        HotKeys(share=0.001, k=10)


@pytest.mark.parametrize("on", [{"k": "p"}, {"k": "p", "s": "q"}])
@pytest.mark.parametrize("hot", [True, False])
@pytest.mark.parametrize("value", [None, "v"])
def test_equals_the_plain_join(spark, on, hot, value):
    c, p = child(spark, 6000), parent(spark, hot)
    rows = lambda df: sorted(map(str, df.collect()))
    got = match_keys(c, p, on, value=value, spread=["id"])
    assert rows(got) == rows(match_keys(c, p, on, value=value, hot=None))
    assert got.count() == 6000


def test_a_hot_key_does_not_fill_one_task(spark):
    """Broadcasts by size are off; two thirds of the rows hold one key and a sixth none."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def sizes(df):
            last = df.columns[-1]  # used, or the join would go
            return sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n"), F.max(last)).collect())
        spread = sizes(match_keys(child(spark), parent(spark), {"k": "p"}, spread=["id"]))
        plain = sizes(match_keys(child(spark), parent(spark), {"k": "p"}, hot=None))
        assert sum(spread) == sum(plain) == 60_000
        assert max(plain) > 5 * plain[len(plain) // 2]
        assert max(spread) <= 2 * spread[len(spread) // 2]
        flagged = E.flag_rejects(child(spark), {}, [E.Parent("p", parent(spark, False), {"k": "p"})], spread=["id"])
        assert max(sizes(flagged)) <= 2 * sizes(flagged)[len(sizes(flagged)) // 2]
        assert flagged.where("k = 1 AND reject_reason = 'missing p'").count() == child(spark).where("k = 1").count() >= 40_000
        assert flagged.where("k IS NULL AND reject_reason IS NOT NULL").count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_lookup_reads_keys_or_derives_them(spark):
    dim = parent(spark).withColumn("dk", F.concat(F.lit("d"), F.col("p").cast("string")))
    out = W.lookup(child(spark, 600), dim, {"k": "p"}, "dk", key_of=None)
    assert {r.dk for r in out.where("k = 1").collect()} == {"d1"} and {r.dk for r in out.where("k IS NULL").collect()} == {"-1"}


def test_unused_key_costs_no_join(spark):
    out = W.lookup(child(spark), parent(spark), {"k": "p"}, "key", spread=["id"]).groupBy("s").count()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "approx_top_k" not in plan


@pytest.mark.parametrize("on", [{"k": "p"}, {"k": "p", "s": "q"}])
@pytest.mark.parametrize("few", [100_000, 1])  # missing keys broadcast; too many for that
def test_settled_equals_the_plain_join(spark, on, few):
    c, rows = child(spark, 6000), lambda df: sorted(map(str, df.collect()))
    for p in (parent(spark, False), parent(spark).limit(0), spark.range(-1, 9000).select(F.col("id").alias("p"), F.lit("a").alias("q"))):
        got = match_keys(c, p, on, spread=["id"], hot=HotKeys(few=few), settled=True)
        assert rows(got) == rows(match_keys(c, p, on, hot=None))


def test_rows_are_not_shuffled_where_no_key_is_missing(spark):
    """Broadcasts by size are off, as for parents of any size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        every = spark.range(-1, 9000).withColumnRenamed("id", "p")
        for p, joins in ((every, 0), (every.where("p <> 1"), 1)):
            out = E.flag_rejects(child(spark), {}, [E.Parent("p", p, {"k": "p"})], spread=["id"])
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert plan.count("BroadcastHashJoin") == joins and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
            assert out.where("reject_reason IS NOT NULL").count() == (child(spark).where("k = 1").count() if joins else 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
