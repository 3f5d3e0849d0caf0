"""Dashboard marts B1-B14: the tables the sales, customer, payment and
satisfaction dashboards read.

Every mart aggregates first (partial + final hash aggregate, so a hot key is
combined inside each map task) and only then applies windows; a window here
runs over months, types or scores, whose count does not grow with the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_marts.functions.columns import MONEY, month_start, ratio
from retail_marts.operators.ranking import exact_percentiles, null_safe_on


QUANTILE = T.DecimalType(20, 6)


def _sum_money(c: str) -> Column:
    return F.sum(F.col(c)).cast(MONEY)


# Sales ----------------------------------------------------------------------

def sales_kpis(sales: DataFrame, by: list[str]) -> DataFrame:
    """B1: net revenue, orders, lines, units and mean order value per ``by``."""
    return (sales.groupBy(*by)
                 .agg(_sum_money("net_amount").alias("net_revenue"),
                      F.countDistinct("order_id").alias("orders"),
                      F.count(F.lit(1)).alias("lines"),
                      _sum_money("quantity").alias("units"))
                 .withColumn("avg_order_value", ratio("net_revenue", "orders")))


def fill_months(monthly: DataFrame, measures: dict[str, Column], col: str = "month") -> DataFrame:
    """Add a row for every month missing between the first and the last
    month of ``monthly`` (one row per month), with the ``measures``' zero
    values; the row of a null month stays. Works on the monthly rows alone (``lead`` + ``sequence``), so the
    fact under them is not read twice."""
    withnext = monthly.withColumn("_next", F.lead(col).over(Window.orderBy(col)))
    upto = F.coalesce(F.add_months(F.col("_next"), -1), F.col(col))
    g = withnext.withColumn("_m", F.explode_outer(F.sequence(F.col(col), upto, F.expr("INTERVAL 1 MONTH"))))
    same = F.col("_m").eqNullSafe(F.col(col))
    return g.select(F.col("_m").alias(col),
                    *[F.when(same, F.col(name)).otherwise(zero).alias(name) for name, zero in measures.items()])


def sales_by_month(sales: DataFrame) -> DataFrame:
    """B2: net revenue per month and its change on the previous month.

    Months without sales between the first and the last show 0, so the
    change always compares calendar neighbours. The first month has no
    previous one (null); a zero base gives null. ``lag`` runs over the
    monthly totals (one row per month), not the lines.
    """
    agg = (sales.groupBy(month_start("ordered_at").alias("month"))
                .agg(_sum_money("net_amount").alias("net_revenue"),
                     F.countDistinct("order_id").alias("orders")))
    m = fill_months(agg, {"net_revenue": F.lit(0).cast(MONEY), "orders": F.lit(0).cast("bigint")})
    w = Window.orderBy("month")
    prev = F.when(F.lag("month").over(w).isNotNull(), F.lag("net_revenue").over(w))  # undated rows are no month
    return (m.withColumn("prev_net_revenue", prev)
             .withColumn("mom_change", ratio(F.col("net_revenue") - F.col("prev_net_revenue"),
                                             F.col("prev_net_revenue"))))


def sales_ytd(sales: DataFrame) -> DataFrame:
    """Monthly net revenue and the year-to-date running total."""
    m = (sales.groupBy(month_start("ordered_at").alias("month"))
              .agg(_sum_money("net_amount").alias("net_revenue")))
    w = (Window.partitionBy(F.year("month")).orderBy("month")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (m.withColumn("year", F.year("month"))
             .withColumn("ytd_net_revenue", F.sum("net_revenue").over(w).cast(MONEY)))


def _cells(sales: DataFrame, dims: list[str]) -> DataFrame:
    """One row per finest cell. Subtotals are built from these, not from the lines, so ``Expand``
    copies cells only."""
    return sales.groupBy(*dims).agg(_sum_money("net_amount").alias("_net"), F.count(F.lit(1)).alias("_lines"))


def sales_rollup(sales: DataFrame, levels: list[str]) -> DataFrame:
    """Revenue by a hierarchy (e.g. region > nation) with every subtotal
    and the grand total; ``level`` is ``grouping_id`` (0 = finest)."""
    return (_cells(sales, levels).rollup(*levels)
            .agg(_sum_money("_net").alias("net_revenue"),
                 F.coalesce(F.sum("_lines"), F.lit(0)).cast("bigint").alias("lines"),
                 F.grouping_id().cast("int").alias("level")))


def sales_cube(sales: DataFrame, dims: list[str]) -> DataFrame:
    """Cross-tab of ``dims`` with all subtotals; ``g_<dim>`` = 1 where
    the dimension is rolled up."""
    return (_cells(sales, dims).cube(*dims)
            .agg(_sum_money("_net").alias("net_revenue"),
                 F.coalesce(F.sum("_lines"), F.lit(0)).cast("bigint").alias("lines"),
                 *[F.grouping(d).cast("int").alias(f"g_{d}") for d in dims]))


def sales_cube_orders(sales: DataFrame, dims: list[str], id_col: str = "order_id") -> DataFrame:
    """B5 with distinct orders at every level (an order's lines may lie in several cells, so
    its count doesn't add up).

    A cell keeps its orders as exact sets: one bitmap per 32,768 consecutive order ids.
    Subtotals join bitmaps with OR, level by level over the cells; the lines are read and
    aggregated once, and no level counts distinct ids of its own. Ids are whole numbers of 0 or more.
    """
    bucket, bit = F.bitmap_bucket_number(id_col), F.bitmap_bit_position(id_col)
    cells = sales.groupBy(*dims, bucket.alias("_bucket")).agg(
        _sum_money("net_amount").alias("_net"), F.count(F.lit(1)).alias("_lines"), F.bitmap_construct_agg(bit).alias("_ids"))
    sets = [[*[d for i, d in enumerate(dims) if not m >> i & 1], "_bucket"] for m in range(1 << len(dims))]
    levels = cells.groupingSets([[F.col(c) for c in g] for g in sets], *dims, "_bucket").agg(
        _sum_money("_net").alias("_net"), F.sum("_lines").alias("_lines"), F.bitmap_count(F.bitmap_or_agg("_ids")).alias("_orders"),
        *[F.grouping(d).cast("int").alias(f"g_{d}") for d in dims])
    return levels.groupBy(*dims, *[f"g_{d}" for d in dims]).agg(
        _sum_money("_net").alias("net_revenue"), F.sum("_lines").cast("bigint").alias("lines"), F.sum("_orders").cast("bigint").alias("orders"))


def top_products(sales: DataFrame, n: int, within: str | None = None) -> DataFrame:
    """The ``n`` products with most net revenue, overall or within each
    value of ``within``; ties go to the smaller product id.

    Overall: ``orderBy().limit()`` is a take-ordered (each task keeps its
    own top n, the driver merges n x tasks rows). Within a group: a
    ``row_number() <= n`` filter, which Spark turns into a partial
    window-group limit before the shuffle, so a large group is cut to n rows
    per task before it is sorted.
    """
    keys = ["product_id"] + ([within] if within else [])
    per = sales.groupBy(*keys).agg(_sum_money("net_amount").alias("net_revenue"),
                                   _sum_money("quantity").alias("units"))
    order = [F.col("net_revenue").desc(), F.col("product_id").asc()]
    if within is None:
        w = Window.orderBy(*order)
        top = per.orderBy(*order).limit(n)
        return top.withColumn("rank", F.row_number().over(w).cast("int"))
    w = Window.partitionBy(within).orderBy(*order)
    return (per.withColumn("rank", F.row_number().over(w).cast("int"))
               .filter(F.col("rank") <= n))


# Customers ------------------------------------------------------------------

def new_vs_returning(orders: DataFrame) -> DataFrame:
    """Per month, orders and customers split into new and returning.

    ``orders`` has order_id, customer_id, ordered_at (one row per order). An
    order is new if it is its customer's first by (date, order id); a
    customer is new in the month of that order. Orders without a customer
    count in ``orders`` only (neither new nor returning).

    One scan and one shuffle of the orders: a partial + final aggregate per
    (month, customer) keeps the count and the earliest (date, order id);
    everything else is computed from that much smaller table, where a
    customer has at most one row per month, so the window per customer is
    small even for a customer with a huge order history.
    """
    mc = (orders.groupBy(month_start("ordered_at").alias("month"), F.col("customer_id"))
                .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ordered_at", "order_id")).alias("f")))
    # a customer has at most one row per month here, so this window is small
    first = F.min("f").over(Window.partitionBy("customer_id"))
    flagged = mc.withColumn("_first_month", month_start(first.getField("ordered_at")))
    is_new = F.col("customer_id").isNotNull() & (F.col("_first_month") == F.col("month"))
    out = flagged.groupBy("month").agg(
        F.sum("n").alias("orders"),
        F.sum(F.when(F.col("customer_id").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
        F.count("customer_id").alias("customers"),
        F.sum(F.when(is_new, 1).otherwise(0)).alias("new_customers"))
    return out.select(
        "month",
        F.col("orders").cast("bigint").alias("orders"),
        F.col("new_customers").cast("bigint").alias("new_orders"),
        (F.col("known") - F.col("new_customers")).cast("bigint").alias("returning_orders"),
        F.col("customers").cast("bigint").alias("customers"),
        F.col("new_customers").cast("bigint").alias("new_customers"),
        (F.col("customers") - F.col("new_customers")).cast("bigint").alias("returning_customers"))


def repeat_rate(orders: DataFrame) -> DataFrame:
    """How many customers placed 1, 2, 3, ... orders, their share, and
    the repeat rate (share of customers with two or more orders) on each
    line. A ``groupBy`` of a ``groupBy``; the window runs over the
    distribution, whose size is the largest order count."""
    per = (orders.filter(F.col("customer_id").isNotNull())
                 .groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")))
    dist = per.groupBy(F.col("n").cast("bigint").alias("orders_per_customer")) \
              .agg(F.count(F.lit(1)).alias("customers"))
    allw = Window.partitionBy()
    total = F.sum("customers").over(allw)
    repeat = F.sum(F.when(F.col("orders_per_customer") >= 2, F.col("customers")).otherwise(0)).over(allw)
    return (dist.withColumn("customer_share", ratio("customers", total))
                .withColumn("repeat_rate", ratio(repeat, total)))


def customers_by(dim_customer: DataFrame, sales: DataFrame, by: list[str]) -> DataFrame:
    """Customers, active customers, net revenue and revenue per customer
    by customer attributes. Sales are summed per customer first, then joined
    to the dimension with a left join, so customers without orders count (with
    zero revenue). The unknown member is not a customer and is left out.
    The join is on the natural key, so the fact needs no key lookup here.
    """
    per = (sales.filter(F.col("customer_id").isNotNull())
                .groupBy("customer_id").agg(_sum_money("net_amount").alias("rev")))
    d = dim_customer.filter(F.col("customer_id").isNotNull())
    j = d.join(per, "customer_id", "left")
    return (j.groupBy(*by)
             .agg(F.count(F.lit(1)).alias("customers"),
                  F.count("rev").alias("active_customers"),
                  F.coalesce(F.sum("rev"), F.lit(0)).cast(MONEY).alias("net_revenue"))
             .withColumn("revenue_per_customer", ratio("net_revenue", "customers")))


# Payments -------------------------------------------------------------------

def payments_by_type(pay: DataFrame) -> DataFrame:
    """Payments, amount and share of the amount per payment type."""
    t = pay.groupBy("payment_type").agg(F.count(F.lit(1)).alias("payments"),
                                        _sum_money("amount").alias("amount"))
    return t.withColumn("amount_share", ratio("amount", F.sum("amount").over(Window.partitionBy())))


def payments_pivot(pay: DataFrame, types: list[str], period: str = "month") -> DataFrame:
    """Amount per period with one column per payment type
    (``amount_<type>``), types listed by the caller (no extra job to find
    them). A type outside the list is left out; no payment gives null."""
    if period not in ("month", "day", "year"):
        raise ValueError(f"period must be month, day or year, not {period!r}")
    per = {"month": month_start("paid_at"), "day": F.to_date("paid_at"),
           "year": F.trunc(F.to_date("paid_at"), "year")}[period]
    p = (pay.withColumn(period, per)
            .groupBy(period).pivot("payment_type", types).agg(_sum_money("amount")))
    return p.select(period, *[F.col(f"`{t}`").cast(MONEY).alias(f"amount_{t.lower()}") for t in types])


def payment_sketches(pay: DataFrame, by: list[str], k: int = 800) -> DataFrame:
    """B12, approximate form, to be stored: payments, amount and a KLL quantile sketch of the amounts per ``by``
    and month (``month`` null: undated).

    A sketch's size depends on ``k`` alone (some kilobytes) and is built map-side, so a hot type shuffles
    sketches, not rows. Payments without an amount are counted but not sketched. ``sketch_stats``
    merges the sketches over any set of months and any coarser grouping.
    """
    value = F.col("amount").cast("double")
    return (pay.withColumn("month", month_start("paid_at")).groupBy(*by, "month")
               .agg(F.count(F.lit(1)).alias("payments"), _sum_money("amount").alias("amount"),
                    F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch")))


def sketch_stats(stored: DataFrame, by: list[str], ranks: dict[str, float] | None = None) -> DataFrame:
    """Payments, amount, mean and approximate quantiles per ``by`` from rows of ``payment_sketches`` (filter them to a
    period first). With k = 800 a quantile's rank is off by less than 0.01 (99 % bound: about 0.004);
    ``ranks`` maps output names to ranks. A group without amounts has null quantiles."""
    ranks = ranks or {"median_amount": 0.5, "p90_amount": 0.9, "p99_amount": 0.99}
    m = stored.groupBy(*by).agg(F.sum("payments").cast("bigint").alias("payments"), _sum_money("amount").alias("amount"),
                                F.kll_merge_agg_double("sketch").alias("_s"))
    some = F.kll_sketch_get_n_double("_s") > 0
    return m.select(*by, "payments", "amount", ratio("amount", "payments").alias("mean_amount"),
                    *[F.when(some, F.kll_sketch_get_quantile_double("_s", F.lit(float(r)))).alias(n) for n, r in ranks.items()])


def rank_errors(pay: DataFrame, quantiles: DataFrame, by: list[str], ranks: dict[str, float]) -> DataFrame:
    """How far each quantile's exact rank in ``pay`` lies from the asked one, per ``by`` (0 where the asked rank falls within
    the share of rows equal to it): one aggregate, ``quantiles`` holding a row per group."""
    q = quantiles.select(*[F.col(c).alias(f"_{c}") for c in by], *ranks)
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    v = F.col("amount").cast("double")
    rows = pay.where("amount IS NOT NULL").join(q, on)
    agg = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"),
                                *[F.sum((v < F.col(n)).cast("bigint")).alias(f"_lt_{n}") for n in ranks],
                                *[F.sum((v <= F.col(n)).cast("bigint")).alias(f"_le_{n}") for n in ranks])
    return agg.select(*by, *[F.greatest(ratio(f"_lt_{n}", "_n") - F.lit(r), F.lit(r) - ratio(f"_le_{n}", "_n"), F.lit(0.0)).alias(n)
                             for n, r in ranks.items()])


def payment_stats(pay: DataFrame, by: list[str], exact: bool = True,
                  accuracy: int = 10000, **kw) -> DataFrame:
    """Payments, mean, median, p90 and p99 of the amount per ``by``.

    ``exact=True``: exact interpolated percentiles computed without gathering
    a group into one task (``ranking.exact_percentiles``), in exact decimals.
    ``exact=False``: ``percentile_approx`` with a fixed-size sketch per group.

    Quantiles are decimal(20,6): interpolating between cent values at a
    position with at most two decimals gives at most four decimals.
    """
    names = ["median_amount", "p90_amount", "p99_amount"]
    base = (pay.groupBy(*by)
               .agg(F.count(F.lit(1)).alias("payments"), _sum_money("amount").alias("amount"))
               .select(*by, "payments", "amount", ratio("amount", "payments").alias("mean_amount")))
    if exact:
        q = exact_percentiles(pay.withColumn("amount", F.col("amount").cast(MONEY)), by, "amount",
                              [0.5, 0.9, 0.99], **kw)
        q = q.select(*[F.col(b).alias(f"_q_{b}") for b in by],
                     *[F.col(f"p{i}").alias(n) for i, n in enumerate(names)])
    else:
        approx = F.percentile_approx(F.col("amount").cast("double"), [0.5, 0.9, 0.99], accuracy)
        q = pay.groupBy(*[F.col(b).alias(f"_q_{b}") for b in by]).agg(approx.alias("_a")).select(
            *[f"_q_{b}" for b in by], *[F.col("_a")[i].cast(QUANTILE).alias(n) for i, n in enumerate(names)])
    if not by:
        return _side_by_side(base, q)
    joined = base.join(q, null_safe_on(by, [f"_q_{b}" for b in by]), "inner")
    return joined.drop(*[f"_q_{b}" for b in by])


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row frames as one row (a join on a constant key, not a cross join)."""
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one").drop("_one")


# Satisfaction ---------------------------------------------------------------

def rating_distribution(r: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Ratings per score and their share (within ``by`` if given)."""
    by = by or []
    d = r.groupBy(*by, "score").agg(F.count(F.lit(1)).alias("ratings"))
    return d.withColumn("share", ratio("ratings", F.sum("ratings").over(Window.partitionBy(*by))))


def satisfaction_by(r: DataFrame, by: list[str], min_n: int = 1) -> DataFrame:
    """Ratings, mean score and satisfied rate per ``by``; groups with
    fewer than ``min_n`` ratings are left out."""
    return (r.groupBy(*by)
             .agg(F.count(F.lit(1)).alias("ratings"),
                  F.sum("score").cast("bigint").alias("_s"),
                  F.sum("satisfied").cast("bigint").alias("_ok"))
             .filter(F.col("ratings") >= min_n)
             .select(*by, "ratings", ratio("_s", "ratings").alias("mean_score"),
                     ratio("_ok", "ratings").alias("satisfied_rate")))
