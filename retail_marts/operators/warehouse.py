"""Warehouse operators: dimensions (W1-W4), keys (W5 in ``functions``),
key lookup (W6), the three facts (W7-W9) and drill-across (W10).

Dimension keys are SHA-256 hashes of the natural key (``dim_key``): they
need no global numbering (no single-task ``row_number``), and the same value
comes out of any engine. Every dimension carries one unknown member
(``'-1'``) so a fact never loses a row on lookup.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_marts.operators.etl import latest_per_key
from retail_marts.operators.skew import HotKeys, match_keys
from retail_marts.functions.columns import (
    MONEY, RATE, UNKNOWN_KEY, date_key, dim_key, month_key, month_start, to_day,
)

# W1 ------------------------------------------------------------------------

def dim_date(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day from ``first`` to ``last`` of the one-row ``bounds``.

    The day list is bounded by the calendar (a century is 36,525 rows), so it
    is built by ``sequence`` + ``explode`` and is safe to broadcast.
    """
    days = bounds.select(F.explode(F.sequence(to_day(F.col(first)), to_day(F.col(last)))).alias("date"))
    d = F.col("date")
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.weekofyear(d).alias("iso_week"),
        F.weekday(d).alias("weekday"),            # 0 = Monday
        month_start(d).alias("month_start"),
        month_key(d).alias("month_key"),
    )


def dim_date_between(spark, first: str, last: str) -> DataFrame:
    bounds = spark.range(1).select(F.to_date(F.lit(first)).alias("first_day"),
                                   F.to_date(F.lit(last)).alias("last_day"))
    return dim_date(bounds)


def date_bounds(df: DataFrame, *cols: str) -> DataFrame:
    """One row (first_day, last_day) covering the given timestamp columns.

    Computed by a partial + final aggregate; nothing is collected.
    """
    lo = F.least(*[F.min(to_day(c)) for c in cols]) if len(cols) > 1 else F.min(to_day(cols[0]))
    hi = F.greatest(*[F.max(to_day(c)) for c in cols]) if len(cols) > 1 else F.max(to_day(cols[0]))
    return df.agg(lo.alias("first_day"), hi.alias("last_day"))


# W2-W4 ---------------------------------------------------------------------

def _geography(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Nation with its region; Catalyst broadcasts what is small enough."""
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
                  .select("n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region")))


def _with_unknown(dim: DataFrame, key: str) -> DataFrame:
    """Append the unknown member: key '-1', every other column null."""
    spark = dim.sparkSession
    row = spark.range(1).select(*[
        (F.lit(UNKNOWN_KEY) if f.name == key else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in dim.schema.fields])
    return dim.unionByName(row)


def _one_per_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The rows of a dimension's source, of a key listed more than once the largest (E3's rule for ties);
    a null key is no member, the unknown one stands for it."""
    return latest_per_key(df.where(F.col(key).isNotNull()).select(key, *columns), [key], [])


def dim_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One row per customer, geography folded in."""
    geo = _geography(nation, region)
    customer = _one_per_key(customer, "c_custkey", ["c_name", "c_nationkey", "c_mktsegment", "c_acctbal"])
    d = (customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
         .select(dim_key("c_custkey").alias("customer_key"),
                 F.col("c_custkey").alias("customer_id"),
                 F.col("c_name").alias("customer_name"),
                 F.col("nation"), F.col("region"),
                 F.col("c_mktsegment").alias("segment"),
                 F.col("c_acctbal").cast(MONEY).alias("acct_balance")))
    return _with_unknown(d, "customer_key")


def dim_product(part: DataFrame) -> DataFrame:
    """One row per part."""
    part = _one_per_key(part, "p_partkey", ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    d = part.select(dim_key("p_partkey").alias("product_key"),
                    F.col("p_partkey").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_brand").alias("brand"),
                    F.col("p_type").alias("product_type"),
                    F.col("p_size").alias("size"),
                    F.col("p_retailprice").cast(MONEY).alias("retail_price"))
    return _with_unknown(d, "product_key")


def dim_seller(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One row per supplier, geography folded in."""
    geo = _geography(nation, region)
    supplier = _one_per_key(supplier, "s_suppkey", ["s_name", "s_nationkey", "s_acctbal"])
    d = (supplier.join(geo, supplier.s_nationkey == geo.n_nationkey, "left")
         .select(dim_key("s_suppkey").alias("seller_key"),
                 F.col("s_suppkey").alias("seller_id"),
                 F.col("s_name").alias("seller_name"),
                 F.col("nation"), F.col("region"),
                 F.col("s_acctbal").cast(MONEY).alias("acct_balance")))
    return _with_unknown(d, "seller_key")


# W6 ------------------------------------------------------------------------

def lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str], key: str,
           as_: str | None = None, key_of: Callable[..., Column] | None = dim_key,
           hot: HotKeys | None = HotKeys(), spread: list[str] | None = None,
           counted: DataFrame | None = None, settled: bool = False) -> DataFrame:
    """Add ``dim``'s surrogate ``key`` to ``fact`` by natural key.

    ``on`` maps fact columns to the dimension's natural key columns. A left
    join against the distinct natural keys of the dimension, so the fact
    keeps exactly its rows; no match (or a null natural key) gives ``'-1'``.

    Every dimension here keys its rows with ``dim_key`` (W5), so the key of
    a matched row is derived from the natural key (``key_of``) and only the
    natural key columns cross the join. With ``key_of=None`` the key is read
    from the dimension instead. When a query does not use the key, Catalyst
    removes the whole join.

    AQE can't split a hot key here, as the distinct keys are an aggregate; the
    join itself does (``skew.match_keys``): keys that hold a large share of the
    fact are resolved from a bounded side table, null keys pass by, the rest is
    joined by shuffle. ``hot``, ``spread``, ``counted`` and ``settled`` (for a key that is used for
    certain: its missing members are found now, and the fact isn't shuffled) are passed on to it; ``hot=None`` joins plainly.
    """
    as_ = as_ or key
    if key_of is not None:
        out = match_keys(fact, dim, on, "_hit", hot=hot, spread=spread, counted=counted, settled=settled, stored=False)
        matched = F.when(F.col("_hit"), key_of(*[F.col(fc) for fc in on]))
    else:
        out = match_keys(fact, dim, on, "_hit", key, hot, spread, counted)
        matched = F.col("_hit")
    return out.select(*fact.columns, F.coalesce(matched, F.lit(UNKNOWN_KEY)).alias(as_))


# W7 ------------------------------------------------------------------------

def _money_round(c: Column) -> Column:
    return F.round(c, 2).cast(MONEY)


def sales_orders(orders: DataFrame, dim_customer: DataFrame | None = None, settled: bool = False) -> DataFrame:
    """The order side of the sales fact: order key, customer id and key,
    status, order time. The customer lookup runs here, on orders, where it
    touches 4x fewer rows than on lines."""
    o = orders.select(F.col("o_orderkey"), F.col("o_custkey").alias("customer_id"),
                      F.upper(F.trim(F.col("o_orderstatus"))).alias("order_status"),
                      F.col("o_orderdate").alias("ordered_at"))
    if dim_customer is not None:
        return lookup(o, dim_customer, {"customer_id": "customer_id"}, "customer_key", spread=["o_orderkey"],
                      counted=orders.select(F.col("o_custkey").alias("customer_id")), settled=settled)
    return o.withColumn("customer_key", dim_key("customer_id"))


def sales_measures(lines_with_orders: DataFrame, dim_product: DataFrame | None = None,
                   dim_seller: DataFrame | None = None, lines: DataFrame | None = None,
                   settled: tuple[str, ...] = ()) -> DataFrame:
    """The sales fact from lines (source columns) already joined to
    ``sales_orders``: measures, product and seller keys, date keys. Hot
    product and seller keys are counted in ``lines``, the lines before the join."""
    lines = lines_with_orders if lines is None else lines
    s = lines_with_orders.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").cast(MONEY).alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("gross_amount"),
        F.col("l_discount").cast(RATE).alias("discount_rate"),
        F.col("l_tax").cast(RATE).alias("tax_rate"),
        F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").alias("shipped_at"),
        "customer_id", "customer_key", "order_status", "ordered_at")
    if dim_product is not None:
        s = lookup(s, dim_product, {"product_id": "product_id"}, "product_key", spread=["order_id", "line_no"],
                   counted=lines.select(F.col("l_partkey").alias("product_id")), settled="product" in settled)
    else:
        s = s.withColumn("product_key", dim_key("product_id"))
    if dim_seller is not None:
        s = lookup(s, dim_seller, {"seller_id": "seller_id"}, "seller_key", spread=["order_id", "line_no"],
                   counted=lines.select(F.col("l_suppkey").alias("seller_id")), settled="seller" in settled)
    else:
        s = s.withColumn("seller_key", dim_key("seller_id"))
    disc = _money_round(F.col("gross_amount") * F.col("discount_rate"))
    net = (F.col("gross_amount") - F.col("discount_amount")).cast(MONEY)
    return (s.withColumn("discount_amount", disc)
             .withColumn("net_amount", net)
             .withColumn("tax_amount", _money_round(F.col("net_amount") * F.col("tax_rate")))
             .select("order_id", "line_no", "customer_id", "product_id", "seller_id",
                     "customer_key", "product_key", "seller_key",
                     date_key("ordered_at").alias("order_date_key"),
                     date_key("shipped_at").alias("ship_date_key"),
                     month_key("ordered_at").alias("month_key"),
                     "ordered_at", "shipped_at", "order_status", "return_flag", "line_status",
                     "quantity", "gross_amount", "discount_rate", "discount_amount", "net_amount",
                     "tax_rate", "tax_amount"))


def fact_sales(lineitem: DataFrame, orders: DataFrame, dim_customer: DataFrame | None = None,
               dim_product: DataFrame | None = None, dim_seller: DataFrame | None = None,
               settled: tuple[str, ...] = ()) -> DataFrame:
    """One row per order line (inner join of lines and orders).

    gross = extended price; discount amount = gross x discount (to the cent);
    net = gross - discount amount; tax = net x tax rate (to the cent). All
    exact decimal(18,2).

    Keys: with a dimension given, the key comes from a lookup (W6) and an
    unmatched member becomes ``'-1'``. Without one (the rows were already
    checked against their parents by ``split_rejects``), the key is the hash
    of the natural key and no join is spent on it. ``settled`` names the dimensions
    (customer, product, seller) whose key is used for certain (``lookup``).
    """
    o = sales_orders(orders, dim_customer, "customer" in settled)
    joined = lineitem.join(o, lineitem.l_orderkey == o.o_orderkey, "inner")
    return sales_measures(joined, dim_product, dim_seller, lineitem, settled)


# W8 ------------------------------------------------------------------------

def fact_payments(payments: DataFrame, dim_customer: DataFrame | None = None) -> DataFrame:
    """One row per payment.

    Input shape: payment_id, customer_id, payment_type, amount, paid_at
    (``plans.standins.payments_source`` maps the test tables onto it).
    Type is trimmed and upper-cased; blank becomes null.
    """
    p = payments.select(
        F.col("payment_id"), F.col("customer_id"),
        F.upper(F.when(F.trim("payment_type") == "", None).otherwise(F.trim("payment_type")))
         .alias("payment_type"),
        F.col("amount").cast(MONEY).alias("amount"),
        F.col("paid_at"))
    if dim_customer is not None:
        p = lookup(p, dim_customer, {"customer_id": "customer_id"}, "customer_key", spread=["payment_id"])
    else:
        p = p.withColumn("customer_key", dim_key("customer_id"))
    return p.select("payment_id", "customer_id", "customer_key", "payment_type", "amount", "paid_at",
                    date_key("paid_at").alias("date_key"), month_key("paid_at").alias("month_key"))


# W9 ------------------------------------------------------------------------

def fact_ratings(ratings: DataFrame, satisfied_from: int = 1) -> DataFrame:
    """One row per rating: score, satisfied flag (score >= ``satisfied_from``),
    comment length in characters and words, and the rating's attributes.

    Input shape: rating_id, score, comment, lang, source
    (``plans.standins.ratings_source``).
    """
    txt = F.col("comment")
    words = F.when(F.trim(txt) == "", F.lit(0)).otherwise(F.size(F.split(F.trim(txt), r"\s+")))
    return ratings.select(
        F.col("rating_id"), F.col("score").cast("int").alias("score"),
        (F.col("score") >= satisfied_from).cast("int").alias("satisfied"),
        F.length(txt).cast("bigint").alias("comment_chars"),
        F.when(txt.isNull(), None).otherwise(words).cast("bigint").alias("comment_words"),
        F.col("lang"), F.col("source"), txt.alias("comment"))


# W10 -----------------------------------------------------------------------

def drill_across(parts: list[tuple[DataFrame, list[Column]]], keys: list[str]) -> DataFrame:
    """Aggregate every fact to the shared ``keys`` first, then put the
    small results side by side. A process with no rows for a key shows nulls; a
    null key is one key. Joining facts row to row would multiply measures.

    The keys must be conformed: of one type in all facts. The results are stacked,
    each with nulls for the measures of the others, and one aggregate picks every
    measure's value, so n facts cost one shuffle of their results and no chain of
    outer joins.
    """
    kinds = [{k: df.schema[k].dataType for k in keys} for df, _ in parts]
    odd = [k for k in keys if len({str(x[k]) for x in kinds}) > 1]
    if odd:
        raise ValueError(f"not conformed, types differ: {odd}")
    results = [df.groupBy(*keys).agg(*measures) for df, measures in parts]
    names = [c for r in results for c in r.columns if c not in keys]
    again = sorted({c for c in names if names.count(c) > 1})
    if again:
        raise ValueError(f"measures of one name in several facts: {again}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
    # a key has one row of each process: the value that isn't null is the measure
    return stacked.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])
