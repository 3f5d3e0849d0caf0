import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from retail_marts.operators import marts as B
from retail_marts.operators import warehouse as W
from retail_marts.plans.star import Dimension, StarModel, UnknownName, slice as star_slice

from fixtures import (ORDERS, ORDERS_SCHEMA, PAYMENTS, PAYMENTS_SCHEMA, RATINGS, RATINGS_SCHEMA)
from test_warehouse import _tpch


def _sales(spark):
    li, o = _tpch(spark)
    return W.fact_sales(li, o)


def test_sales_by_month_gap_zero_base_and_first_month(spark):
    s = _sales(spark)
    # January: orders 1, 2, 3; February: none; March: order 5; December: order 6
    jan_only_free = s.filter("order_id <> 1 or line_no <> 1")       # leaves January = 9.04 + 0 + 19.00
    rows = {r.month: r for r in B.sales_by_month(jan_only_free).collect()}
    assert len(rows) == 12                                 # every month from January to December
    feb, mar = rows[dt.date(2020, 2, 1)], rows[dt.date(2020, 3, 1)]
    assert feb.net_revenue == D("0.00") and feb.orders == 0
    assert rows[dt.date(2020, 1, 1)].prev_net_revenue is None and rows[dt.date(2020, 1, 1)].mom_change is None
    assert mar.prev_net_revenue == D("0.00") and mar.mom_change is None      # zero base
    assert feb.mom_change == -1.0
    # B2 totals agree with B1
    total = B.sales_kpis(jan_only_free, []).first().net_revenue
    assert sum(r.net_revenue for r in rows.values()) == total


def test_sales_ytd_resets_each_year(spark):
    s = _sales(spark)
    rows = {r.month: r for r in B.sales_ytd(s).collect()}
    assert rows[dt.date(2020, 12, 1)].ytd_net_revenue == sum(r.net_revenue for r in rows.values())


def test_rollup_and_cube_totals(spark):
    s = _sales(spark).withColumn("region", F.lit("X")).withColumn("nation", F.col("order_status"))
    r = B.sales_rollup(s, ["region", "nation"]).collect()
    grand = [x for x in r if x.level == 3][0]
    assert grand.net_revenue == B.sales_kpis(s, []).first().net_revenue
    c = B.sales_cube(s, ["order_status", "return_flag"]).collect()
    assert sum(1 for x in c if x.g_order_status == 1 and x.g_return_flag == 1) == 1


def test_top_products_ties_by_key(spark):
    s = _sales(spark)
    top = B.top_products(s, 1).collect()
    assert [(r.product_id, r.rank) for r in top] == [(100, 1)]
    within = B.top_products(s.withColumn("grp", F.col("seller_id")), 1, within="grp").collect()
    assert sorted((r.grp, r.product_id) for r in within) == [(1000, 100), (1001, 101)]


def test_new_vs_returning(spark):
    o = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    rows = {r.month: r for r in B.new_vs_returning(o).collect()}
    jan = rows[dt.date(2020, 1, 1)]
    assert (jan.orders, jan.new_orders, jan.returning_orders) == (4, 2, 1)   # null customer in neither
    assert (jan.customers, jan.new_customers, jan.returning_customers) == (2, 2, 0)
    dec = rows[dt.date(2020, 12, 1)]
    assert (dec.new_orders, dec.returning_orders, dec.returning_customers) == (0, 1, 1)


def test_repeat_rate(spark):
    o = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    rows = {r.orders_per_customer: r for r in B.repeat_rate(o).collect()}
    assert {k: r.customers for k, r in rows.items()} == {1: 3, 3: 1}
    assert rows[1].repeat_rate == 0.25
    assert sum(r.customer_share for r in rows.values()) == pytest.approx(1.0)


def test_customers_by_counts_customers_without_orders(spark):
    from retail_marts.functions.columns import dim_key
    dimc = spark.createDataFrame([(10, "A"), (11, "A"), (12, "B"), (13, "B"), (None, None)],
                                 "customer_id bigint, state string") \
                .withColumn("customer_key", dim_key("customer_id"))
    rows = {r.state: r for r in B.customers_by(dimc, _sales(spark), ["state"]).collect()}
    assert (rows["B"].customers, rows["B"].active_customers) == (2, 0)
    assert rows["B"].net_revenue == D("0.00") and rows["B"].revenue_per_customer == 0.0
    assert None not in rows                                  # unknown member is not a customer


def _pay(spark):
    p = spark.createDataFrame(PAYMENTS, PAYMENTS_SCHEMA).select(
        F.concat(F.col("order_id"), F.lit("-"), F.col("seq")).alias("payment_id"), "customer_id",
        F.col("type").alias("payment_type"), "amount", "paid_at")
    return W.fact_payments(p)


def test_payments_types_standardised_and_shares(spark):
    rows = {r.payment_type: r for r in B.payments_by_type(_pay(spark)).collect()}
    assert set(rows) == {"CREDIT_CARD", "VOUCHER", "BOLETO", None}       # blank and null -> null
    assert rows["CREDIT_CARD"].payments == 2 and rows["CREDIT_CARD"].amount == D("60.00")
    assert sum(r.amount_share for r in rows.values()) == pytest.approx(1.0)


def test_payments_pivot_listed_types_only(spark):
    p = B.payments_pivot(_pay(spark), ["CREDIT_CARD", "VOUCHER"], "month")
    assert p.columns == ["month", "amount_credit_card", "amount_voucher"]
    rows = {r.month: r for r in p.collect()}
    assert rows[dt.date(2020, 1, 1)].amount_credit_card == D("60.00")
    assert rows[dt.date(2020, 12, 1)].amount_credit_card is None          # boleto not listed
    with pytest.raises(ValueError):
        B.payments_pivot(_pay(spark), ["X"], "week")


def test_payment_stats_exact_quantiles(spark):
    vals = [(i, D(i)) for i in range(1, 11)]
    p = spark.createDataFrame(vals, "k int, amount decimal(18,2)").withColumn("payment_type", F.lit("T"))
    r = B.payment_stats(p, ["payment_type"]).first()
    assert (r.median_amount, r.p90_amount, r.p99_amount) == (D("5.5"), D("9.1"), D("9.91"))
    assert r.mean_amount == 5.5 and r.payments == 10


def _ratings(spark):
    r = spark.createDataFrame(RATINGS, RATINGS_SCHEMA).filter("score between 1 and 5").select(
        "rating_id", "score", "comment", F.lit("pt").alias("lang"),
        F.when(F.col("order_id") < 5, "a").otherwise("b").alias("source"))
    return W.fact_ratings(r, satisfied_from=4)


def test_rating_distribution_and_satisfaction(spark):
    r = _ratings(spark)
    d = {x.score: x for x in B.rating_distribution(r).collect()}
    assert {k: v.ratings for k, v in d.items()} == {1: 2, 2: 1, 3: 1, 4: 1, 5: 2}
    assert sum(v.share for v in d.values()) == pytest.approx(1.0)
    s = {x.source: x for x in B.satisfaction_by(r, ["source"], min_n=3).collect()}
    assert set(s) == {"a", "b"} and s["b"].ratings == 4
    assert s["b"].satisfied_rate == 0.75
    assert B.satisfaction_by(r, ["source"], min_n=4).count() == 1


def test_fact_ratings_text_measures(spark):
    rows = {x.rating_id: x for x in _ratings(spark).collect()}
    assert rows[2].comment_chars is None and rows[2].comment_words is None   # null comment
    assert rows[3].comment_chars == 0 and rows[3].comment_words == 0          # empty comment
    assert rows[5].comment_words == 2


def test_slice_checks_names_and_limits(spark):
    s = _sales(spark)
    from retail_marts.functions.columns import dim_key
    dimp = spark.createDataFrame([(100, "B1"), (101, "B2")], "product_id bigint, brand string") \
                .withColumn("product_key", dim_key("product_id"))
    model = StarModel(fact=s, dims={"product": Dimension(dimp, "product_key", "product_key")},
                      measures={"net": lambda: F.sum("net_amount"), "lines": lambda: F.count(F.lit(1))},
                      attributes={"brand": ("product", lambda: F.col("brand")),
                                  "status": (None, lambda: F.col("order_status"))})
    out = star_slice(model, ["net", "lines"], ["brand"], where=[("status", "in", ["F", "P"])],
                     order=[("net", "desc")], n=1).collect()
    assert [(r.brand, r.lines) for r in out] == [("B1", 5)]
    for bad in (dict(measures=["nope"], by=["brand"]), dict(measures=["net"], by=["nope"]),
                dict(measures=["net"], by=["brand"], where=[("brand", "like", "x")]),
                dict(measures=["net"], by=["brand"], order=[("status", "asc")])):
        with pytest.raises(UnknownName):
            star_slice(model, **bad)


def test_empty_inputs_keep_schema(spark):
    s = _sales(spark).limit(0)
    for df in (B.sales_by_month(s), B.sales_ytd(s), B.top_products(s, 3), B.sales_kpis(s, ["return_flag"])):
        assert df.count() == 0 and len(df.columns) > 0
    assert B.sales_kpis(s, []).count() == 1          # a grand total is one row


def test_payment_stats_null_type_group_and_approx(spark):
    rows = {r.payment_type: r for r in B.payment_stats(_pay(spark), ["payment_type"]).collect()}
    assert rows[None].payments == 2 and rows[None].median_amount == D("14.025")
    assert rows["CREDIT_CARD"].median_amount == D("30.00")
    approx = {r.payment_type: r for r in B.payment_stats(_pay(spark), ["payment_type"], exact=False).collect()}
    assert set(approx) == set(rows)
    total = B.payment_stats(_pay(spark), []).collect()
    assert len(total) == 1 and total[0].payments == 6


def test_stored_sketches_merge_to_any_period(spark):
    """Quantiles from monthly sketches, merged, lie within 0.01 of the asked rank; counts and sums are exact."""
    from retail_marts.operators import marts
    pay = spark.range(60_000, numPartitions=7).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('t', id % 2) END AS payment_type",
        "CASE WHEN id % 100 = 7 THEN NULL ELSE CAST(pow(hash(id) % 1000, 2) / 100 AS DECIMAL(18,2)) END AS amount",
        "CASE WHEN id % 50 = 1 THEN NULL ELSE timestamp_ntz '2020-01-15' + make_interval(0, CAST(id % 12 AS INT)) END AS paid_at")
    ranks = {"q1": 0.01, "q50": 0.5, "q99": 0.99}
    stored = marts.payment_sketches(pay, ["payment_type"]).checkpoint()
    assert 0 < stored.count() <= 3 * 13
    for part, rows in ((stored, pay), (stored.where("month < '2020-05-01'"), pay.where("paid_at < '2020-05-01'"))):
        got = marts.sketch_stats(part, ["payment_type"], ranks)
        off = marts.rank_errors(rows, got, ["payment_type"], ranks).collect()
        assert len(off) == 3 and all(0 <= r[n] <= 0.01 for r in off for n in ranks)
        want = {r.payment_type: (r.n, r.s) for r in rows.groupBy("payment_type").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s")).collect()}
        assert {r.payment_type: (r.payments, r.amount) for r in got.collect()} == want
    whole = marts.sketch_stats(stored, [], ranks).collect()
    assert len(whole) == 1 and whole[0].payments == 60_000
    none = pay.where("payment_type = 't1'").withColumn("amount", F.lit(None).cast("decimal(18,2)"))
    assert marts.sketch_stats(marts.payment_sketches(none, ["payment_type"]), ["payment_type"]).first().median_amount is None
    assert marts.sketch_stats(marts.payment_sketches(pay.limit(0), ["payment_type"]), ["payment_type"]).count() == 0
