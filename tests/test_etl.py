from decimal import Decimal as D

from pyspark.sql import functions as F

from retail_marts.operators import etl as E

from fixtures import CUSTOMERS, CUSTOMERS_SCHEMA, LINES, LINES_SCHEMA, ORDERS, ORDERS_SCHEMA


def test_standardise_trims_blanks_codes_money(spark):
    df = spark.createDataFrame([(" a ", "  ", " sp ", 1.5), ("b", None, "Rj", 2.25)],
                               "name string, note string, state string, amt double")
    out = E.standardise(df, {"name": "text", "note": "text", "state": "code", "amt": "money"},
                        {"amt": "amount"}).collect()
    assert [tuple(r) for r in out] == [("a", None, "SP", D("1.50")), ("b", None, "RJ", D("2.25"))]
    assert dict(E.standardise(df, {"amt": "money"}).dtypes)["amt"] == "decimal(18,2)"


def test_latest_per_key_latest_wins_and_ties_are_stable(spark):
    df = spark.createDataFrame(CUSTOMERS, CUSTOMERS_SCHEMA)
    results = set()
    for n in (1, 4, 16):
        got = E.latest_per_key(df.repartition(n), ["customer_id"], ["loaded_at"]).orderBy("customer_id")
        results.add(tuple(tuple(r) for r in got.collect()))
    assert len(results) == 1          # same rows under any partitioning
    rows = {r[0]: r for r in next(iter(results))}
    assert rows[10][1] == " Sao Paulo "               # later date wins
    assert rows[11][1] == "rio"                       # equal dates: larger city wins the tie
    assert len(rows) == 4


def test_split_rejects_orphans_rules_null_keys(spark):
    lines = spark.createDataFrame(LINES + [(None, 1, 100, 1000, D("1.00"), D("0.00"), 1),
                                           (2, 2, 100, 1000, D("1.00"), D("0.00"), 0)], LINES_SCHEMA)
    orders = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    ok, bad = E.split_rejects(lines, {"qty not positive": F.col("qty") > 0,
                                      "discount outside 0..1": F.col("discount").between(0, 1)},
                              [E.Parent("orders", orders, {"order_id": "order_id"})])
    assert ok.count() + bad.count() == lines.count()
    reasons = sorted((r.order_id, r.reject_reason) for r in bad.collect())
    assert reasons == [(2, "qty not positive"), (8, "missing orders")]
    # null key is not an orphan; the exact repeated row stays twice
    assert ok.filter(F.col("order_id").isNull()).count() == 1
    assert ok.filter(F.col("order_id") == 6).count() == 2


def test_parent_with_repeated_keys_does_not_multiply(spark):
    child = spark.createDataFrame([(1,), (2,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    ok, bad = E.split_rejects(child, {}, [E.Parent("p", parent, {"k": "k"})])
    assert ok.count() == 1 and bad.count() == 1


def test_reconcile_balances_and_empty_gives_one_line(spark):
    lines = spark.createDataFrame(LINES, LINES_SCHEMA)
    orders = spark.createDataFrame(ORDERS, ORDERS_SCHEMA)
    ok, bad = E.split_rejects(lines, {}, [E.Parent("orders", orders, {"order_id": "order_id"})])
    r = E.reconcile([("lines", {"source": lines, "accepted": ok, "rejected": bad, "loaded": ok}, "price")]).first()
    assert (r.source_rows, r.accepted_rows, r.rejected_rows, r.loaded_rows) == (8, 7, 1, 7)
    assert r.source_amount == D("295.05") and r.rejected_amount == D("5.00") and r.balanced
    # a load that lost a row is not balanced
    r2 = E.reconcile([("lines", {"source": lines, "accepted": ok, "rejected": bad,
                                 "loaded": ok.limit(6)}, "price")]).first()
    assert not r2.balanced
    empty = spark.createDataFrame([], LINES_SCHEMA)
    e = E.reconcile([("lines", {"source": empty, "accepted": empty, "rejected": empty, "loaded": empty},
                      "price")]).collect()
    assert len(e) == 1 and e[0].source_rows == 0 and e[0].source_amount == D("0.00") and e[0].balanced


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_reconcile_rows_finds_changes_that_cancel(spark):
    a = spark.createDataFrame([(1, 1, D("5.00"), 202001), (2, 1, D("7.00"), 202001), (3, 1, D("9.00"), 202002), (4, 1, None, 202002)],
                              "k int, n int, amt decimal(18,2), m int")
    b = spark.createDataFrame([(4, 1, None, 202002), (3, 1, D("9.00"), 202002), (2, 1, D("6.00"), 202001), (1, 1, D("6.00"), 202001)], a.schema)
    for buckets in (1, 2, 64):
        for n in (1, 7):
            got = E.reconcile_rows([E.Compared("t", a.repartition(n), b, ["k"], F.col("m"))], buckets)
            assert _rows(got) == [("t", 202001, "1", "changed", 1, 1), ("t", 202001, "2", "changed", 1, 1)]
    assert E.reconcile_rows([E.Compared("t", a, a.repartition(3), ["k"], F.col("m"))]).count() == 0


def test_reconcile_rows_counts_repeats_nulls_and_moves(spark):
    schema = "k string, x int, y int, m int"
    a = spark.createDataFrame([("a", 1, None, 1), ("b", 2, 2, 1), ("b", 2, 2, 1), ("c", 3, 3, 1), (None, 4, 4, None)], schema)
    b = spark.createDataFrame([("a", None, 1, 1), ("b", 2, 2, 1), ("c", 3, 3, 2), (None, 4, 4, None), (None, 4, 4, None)], schema)
    got = E.reconcile_rows([E.Compared("t", a, b, ["k"], F.col("m"))])
    assert _rows(got) == [("t", -1, "", "extra", 1, 2),           # repeated, without key or month
                          ("t", 1, "a", "changed", 1, 1),         # null moved to another column
                          ("t", 1, "b", "missing", 2, 1),
                          ("t", 1, "c", "changed", 1, 1)]         # moved to another month
    empty = a.limit(0)
    assert E.reconcile_rows([E.Compared("t", empty, empty, ["k"])]).count() == 0
    assert {r[3] for r in _rows(E.reconcile_rows([E.Compared("t", a, empty, ["k"])]))} == {"missing"}


def test_reconcile_rows_refuses_other_columns(spark):
    import pytest
    a = spark.createDataFrame([(1, 2)], "k int, x int")
    with pytest.raises(ValueError):
        E.reconcile_rows([E.Compared("t", a, a.withColumn("x", F.col("x").cast("bigint")), ["k"])])


def test_reconcile_rows_holds_a_hot_key(spark):
    """A third of the rows under one key is one line of each task's partial aggregate, not a task of its own."""
    a = spark.range(30_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    b = a.withColumn("v", F.when(F.col("v") == 3, F.lit(4)).otherwise(F.col("v")))
    got = _rows(E.reconcile_rows([E.Compared("t", a, b, ["k"])]))
    assert got == [("t", -1, "0", "changed", 10_000, 10_000)]


def test_column_totals(spark):
    import datetime as dt
    from retail_marts.sources import column_totals
    df = spark.createDataFrame([(1, "ab", 1.5, dt.datetime(1970, 1, 3)), (None, None, 2.25, None), (2, "cde", None, dt.datetime(1970, 1, 2))],
                               "n bigint, s string, d double, t timestamp_ntz")
    got = {r.column_name: (r.row_count, r.null_count, r.total) for r in column_totals(df, "x").collect()}
    assert got == {"n": (3, 1, D("3.0000")), "s": (3, 1, D("5.0000")), "d": (3, 1, D("3.7500")), "t": (3, 1, D("3.0000"))}
    assert [r.row_count for r in column_totals(df.limit(0), "x").collect()] == [0] * 4
