import random
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retail_marts.operators import segment as C


def _planted(spark):
    """clusters_planted: three well separated groups of known size, one constant column."""
    rnd = random.Random(3)
    rows, i = [], 0
    for size, (r, f, m) in ((50, (10, 20, 5000)), (30, (200, 2, 300)), (20, (400, 10, 1500))):
        for _ in range(size):
            rows.append((i, r + rnd.uniform(-3, 3), f + rnd.uniform(-1, 1), m + rnd.uniform(-50, 50), 1.0))
            i += 1
    return spark.createDataFrame(rows, "id bigint, r double, f double, m double, c double")


def test_customer_features(spark):
    import datetime as dt
    o = spark.createDataFrame([(1, 10, D("5.00"), dt.datetime(2020, 1, 1)), (2, 10, D("7.50"), dt.datetime(2020, 1, 3)),
                               (3, None, D("1.00"), dt.datetime(2020, 1, 3))],
                              "order_id bigint, customer_id bigint, order_value decimal(18,2), ordered_at timestamp_ntz")
    r = C.customer_features(o, "2020-01-10").collect()
    assert [(x.customer_id, x.recency, x.frequency, x.monetary) for x in r] == [(10, 7, 2, D("12.50"))]
    assert C.default_as_of(o) == "2020-01-04"


def test_score_equals_ntile(spark):
    df = _planted(spark)
    got = C.score(df, "m", "id", 5, rows_per_bucket=13)
    got = C.score(got, "r", "id", 5, descending=True, rows_per_bucket=13)
    ref = df.select("id", F.ntile(5).over(Window.orderBy("m", "id")).alias("a"),
                    F.ntile(5).over(Window.orderBy(F.col("r").desc(), "id")).alias("b"))
    exp = {x.id: (x.a, x.b) for x in ref.collect()}
    assert {x.id: (x.m_score, x.r_score) for x in got.collect()} == exp


def test_scale_constant_column_becomes_zero(spark):
    df = _planted(spark)
    scaled, _ = C.scale(df, ["m", "c"], "z")
    z = C.z_columns(scaled, ["m", "c"])
    assert z.agg(F.max(F.abs("z_c"))).first()[0] == 0
    stats = z.agg(F.avg(F.col("z_m").cast("double")), F.stddev_samp(F.col("z_m").cast("double"))).first()
    assert abs(stats[0]) < 1e-5 and abs(stats[1] - 1) < 1e-5


def test_fit_segments_finds_planted_groups(spark):
    df = _planted(spark)
    seg = C.fit_segments(df, 3, seed=5, cols=["r", "f", "m", "c"], key="id", partitions=4,
                         rank_by="m")
    out = seg.transform(df).select("id", "segment").collect()
    by_group = {}
    for x in out:
        g = 0 if x.id < 50 else (1 if x.id < 80 else 2)
        by_group.setdefault(g, set()).add(x.segment)
    assert all(len(v) == 1 for v in by_group.values())            # every group in one segment
    assert len({next(iter(v)) for v in by_group.values()}) == 3
    assert by_group[0] == {0}            # highest mean monetary is segment 0
    # same result whatever the input partitioning
    again = seg.transform(df.repartition(7)).select("id", "segment").collect()
    assert sorted(out) == sorted(again)


def test_choose_k_prefers_three(spark):
    rows = C.choose_k(_planted(spark), [2, 3, 4], seed=5, cols=["r", "f", "m"], key="id", partitions=4).collect()
    best = max(rows, key=lambda r: r.silhouette)
    assert best.k == 3
    assert [r.k for r in rows] == [2, 3, 4]


def test_assign_nearest_and_ties_to_lower_index(spark):
    df = spark.createDataFrame([(1, D("0.0"), D("0.0")), (2, D("1.0"), D("1.0")), (3, D("0.5"), D("0.5"))],
                               "id int, x decimal(12,6), y decimal(12,6)")
    got = {r.id: r.segment for r in C.assign(df, [[D("0"), D("0")], [D("1"), D("1")]], ["x", "y"]).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_profile_shares(spark):
    df = spark.createDataFrame([(0, 1, 2, D("3")), (0, 3, 4, D("5")), (1, 5, 6, D("7"))],
                               "segment int, recency int, frequency bigint, monetary decimal(18,2)")
    rows = {r.segment: r for r in C.profile(df).collect()}
    assert rows[0].customers == 2 and rows[0].mean_recency == 2.0 and rows[0].mean_monetary == 4.0
    assert sum(r.share for r in rows.values()) == pytest.approx(1.0)


def test_segments_do_not_depend_on_placement(spark):
    """Same centres, costs and silhouettes, bit for bit, from 1, 4 and 16 partitions."""
    df = _planted(spark)
    cols = ["r", "f", "m", "c"]
    fits = [C.fit_segments(df.repartition(p + 1), 4, seed=2, cols=cols, key="id", partitions=p, rank_by="m") for p in (1, 4, 16)]
    assert all(f == fits[0] for f in fits)
    tables = [C.choose_k(df, [2, 3, 5], seed=2, cols=cols, key="id", partitions=p).collect() for p in (1, 4, 16)]
    assert tables[1] == tables[0] and tables[2] == tables[0]


def test_choose_k_equals_brute_force(spark):
    """Cost and silhouette against all pairs of rows in plain Python."""
    df = _planted(spark)
    cols = ["r", "f", "m"]
    seg = C.fit_segments(df, 3, seed=5, cols=cols, key="id", rank_by="m")
    zs = [seg.scaling.units(c) for c in cols]
    pts = [(r[0], [r[i] / C.MICRO for i in (1, 2, 3)]) for r in
           seg.transform(df).select("segment", *[z.alias(f"z{i}") for i, z in enumerate(zs)]).collect()]

    def d(p, q):
        return sum((x - y) ** 2 for x, y in zip(p, q))
    inverse = {s: c for c, s in enumerate(seg.order)}
    cost = sum(d(p, [v / C.MICRO for v in seg.centres[inverse[s]]]) for s, p in pts)
    sil = 0.0
    for i, (s, p) in enumerate(pts):
        mean = {t: [d(p, q) for j, (u, q) in enumerate(pts) if u == t and j != i] for t in range(3)}
        mean = {t: sum(v) / len(v) for t, v in mean.items()}
        a, b = mean[s], min(v for t, v in mean.items() if t != s)
        sil += (b - a) / max(a, b) / len(pts)
    got = C.choose_k(df, [3], seed=5, cols=cols, key="id").first()
    assert got.cost == pytest.approx(cost, abs=2e-4)
    assert got.silhouette == pytest.approx(sil, abs=2e-6)


def test_segments_nulls_repeats_and_empty(spark):
    df = _planted(spark)
    odd = df.unionByName(df.limit(1).withColumn("id", F.lit(1000).cast("bigint")).withColumn("m", F.lit(None).cast("double")))
    seg = C.fit_segments(odd, 3, seed=5, cols=["r", "m"], key="id", rank_by="m")
    assert [r.segment for r in seg.transform(odd).where("id = 1000").collect()] == [None]
    same = spark.createDataFrame([(i, 1.0) for i in range(5)], "id bigint, m double")
    one = C.fit_segments(same, 3, cols=["m"], key="id", rank_by="m")       # fewer different rows than centres
    assert {r.segment for r in one.transform(same).collect()} == {0}
    assert C.choose_k(same, [2], cols=["m"], key="id").first() == (2, 0.0, 0.0)
    none = C.fit_segments(same.limit(0), 3, cols=["m"], key="id", rank_by="m")
    assert none.transform(same).where("segment IS NOT NULL").count() == 0
