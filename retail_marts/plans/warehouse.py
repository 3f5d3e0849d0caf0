"""The warehouse as a lazy model over a source folder, and the batch load.

``Warehouse`` builds every dimension and fact as a DataFrame plan over the
source Parquet files; nothing runs until a mart is asked for. ``load_version``
publishes the warehouse (E1 -> E2 -> E4 -> W -> E6 -> E5) as the next version of a
folder, which ``Warehouse.from_loaded`` reads; ``load`` replaces plain tables.
"""

from __future__ import annotations

import os
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_marts.functions.columns import MONEY, UNKNOWN_KEY, dim_key, month_key
from retail_marts.operators import etl, warehouse as W
from retail_marts.plans import standins
from retail_marts.sources import read_table, remove_table, write_fact, write_table
from retail_marts.sources.published import Publication, read_published


class Warehouse:
    """Dimensions and facts over ``src`` (a folder of source tables).

    ``lookups=True`` resolves every fact key through its dimension (W6),
    which costs one join per dimension. ``lookups=False`` derives the keys
    from the natural keys. ``checked=True`` takes accepted lines only
    (``checked_lines``), which is what the load writes; without it every line that has an
    order counts, and a query joins no more than it needs.
    """

    def __init__(self, spark: SparkSession, src: str, lookups: bool = True, checked: bool = False):
        self.spark, self.src, self.lookups, self.checked = spark, src, lookups, checked

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.src, name)

    # dimensions
    @cached_property
    def dim_customer(self) -> DataFrame:
        return W.dim_customer(self.table("customer"), self.table("nation"), self.table("region"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return W.dim_product(self.table("part"))

    @cached_property
    def dim_seller(self) -> DataFrame:
        return W.dim_seller(self.table("supplier"), self.table("nation"), self.table("region"))

    @cached_property
    def dim_date(self) -> DataFrame:
        o = self.table("orders").select(F.col("o_orderdate").alias("t"))
        li = self.table("lineitem").select(F.col("l_shipdate").alias("t"))
        ev = self.table("events").select(F.col("ts").alias("t"))
        return W.dim_date(W.date_bounds(o.unionByName(li).unionByName(ev), "t"))

    @classmethod
    def from_loaded(cls, spark: SparkSession, root: str, version: int | None = None) -> "LoadedWarehouse":
        """The tables that ``load_version`` has published under ``root``."""
        return LoadedWarehouse(spark, root, version)

    # facts
    def checked_lines(self, customers: DataFrame | None = None) -> DataFrame:
        """Every order line with its order's attributes and its ``reject_reason`` (E4): the one
        place that decides which lines are sales, for the marts and for the load alike.

        The order side (one row per order key, the latest; customer looked up in
        ``customers``) is joined to the lines once: the same join says whether a
        line's order exists and carries the order attributes into the fact, so
        the lines are shuffled by order key once.
        """
        li = self.table("lineitem")
        o_side = W.sales_orders(etl.latest_per_key(self.table("orders"), ["o_orderkey"], ["o_orderdate"]), customers, settled=True)
        li_o = li.join(o_side, li.l_orderkey == o_side.o_orderkey, "left")
        parents = [etl.Parent("part", self.table("part"), {"l_partkey": "p_partkey"}),
                   etl.Parent("supplier", self.table("supplier"), {"l_suppkey": "s_suppkey"})]
        # a line without an order has no date and no customer: a null order key is a reject too
        first = {"missing orders": F.col("o_orderkey").isNotNull()}
        return etl.flag_rejects(li_o, line_rules(), parents, first, spread=["l_orderkey", "l_linenumber"], counted=li)

    def sales_keyed(self, *settled: str) -> DataFrame:
        """``sales`` for a query that uses the keys of these dimensions (customer, product, seller) for certain."""
        if self.checked or not self.lookups:
            return self.sales
        return W.fact_sales(self.table("lineitem"), self.table("orders"), self.dim_customer, self.dim_product, self.dim_seller, settled)

    @cached_property
    def sales(self) -> DataFrame:
        """W7. Accepted lines were checked against products and sellers, so these keys are derived
        from the natural keys; the customer is looked up on the order side."""
        if not self.checked:
            dims = (self.dim_customer, self.dim_product, self.dim_seller) if self.lookups else ()
            return W.fact_sales(self.table("lineitem"), self.table("orders"), *dims)
        ok = self.checked_lines(self.dim_customer if self.lookups else None).filter(F.col("reject_reason").isNull())
        return W.sales_measures(ok.drop("reject_reason"))

    def payments(self, only_types: list[str] | None = None) -> DataFrame:
        src = standins.payments_source(self.table("events"), only_types)
        return W.fact_payments(src, self.dim_customer if self.lookups else None)

    @cached_property
    def ratings(self) -> DataFrame:
        return W.fact_ratings(standins.ratings_source(self.table("labels"), self.table("documents")))

    @cached_property
    def orders(self) -> DataFrame:
        return standins.orders_source(self.table("orders"))


def line_rules() -> dict:
    """E4 value rules for order lines (reason -> condition that must hold)."""
    return {"quantity not positive": F.col("l_quantity") > 0,
            "discount outside 0..1": F.col("l_discount").between(0, 1),
            "price negative": F.col("l_extendedprice") >= 0}


class LoadedWarehouse(Warehouse):
    """The same dimensions and facts, read from a published load: no source table is
    joined or checked again, and a filter on months prunes the facts' folders."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        super().__init__(spark, root)
        self.version = version

    def table(self, name: str) -> DataFrame:
        return read_published(self.spark, self.src, name, self.version)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.table("dim_customer")

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.table("dim_product")

    @cached_property
    def dim_seller(self) -> DataFrame:
        return self.table("dim_seller")

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.table("dim_date")

    def sales_keyed(self, *settled: str) -> DataFrame:
        return self.sales

    @cached_property
    def sales(self) -> DataFrame:
        return self.table("fact_sales")

    @cached_property
    def ratings(self) -> DataFrame:
        return self.table("fact_ratings")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("fact_orders").drop("month_key")

    def payments(self, only_types: list[str] | None = None) -> DataFrame:
        p = self.table("fact_payments")
        return p.filter(F.col("payment_type").isin(*[t.strip().upper() for t in only_types])) if only_types else p


def _reconciled(spark: SparkSession, li: DataFrame, ok: DataFrame, bad: DataFrame, loaded: DataFrame) -> DataFrame:
    price = lambda df, c="l_extendedprice": df.select(F.col(c).cast(MONEY).alias("m"))
    return etl.reconcile([("lineitem", {"source": price(li), "accepted": price(ok), "rejected": price(bad),
                                        "loaded": price(loaded, "gross_amount")}, "m")])


def _staged_lines(wh: Warehouse, path: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected lines of one checked pass, written once partitioned by outcome. The customer's
    key is kept as whether it was found (``customer_known``): ``_loaded_sales`` makes it again."""
    flagged = (wh.checked_lines(wh.dim_customer).withColumn("customer_known", F.col("customer_key") != UNKNOWN_KEY).drop("customer_key")
               .withColumn("outcome", F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")))
    flagged.write.option("compression", "zstd").partitionBy("outcome").parquet(path)
    checked = wh.spark.read.schema(flagged.schema).parquet(path)
    ok = checked.filter(F.col("outcome") == "accepted").drop("outcome", "reject_reason")
    bad = checked.filter(F.col("outcome") == "rejected").drop("outcome")
    return ok, bad.select(*wh.table("lineitem").columns, "reject_reason")


def _loaded_sales(ok: DataFrame) -> DataFrame:
    """The sales fact of staged lines. Product and seller were checked, so their keys are derived; the customer
    was looked up on the order side ('-1' when unknown). Lines are clustered by month here, before the
    keys and measures make them three times as wide."""
    lines = ok.withColumn("month_key", month_key("ordered_at")).hint("rebalance", "month_key")
    key = F.when(F.col("customer_known"), dim_key("customer_id")).otherwise(F.lit(UNKNOWN_KEY))
    return W.sales_measures(lines.withColumn("customer_key", key))


def load_version(spark: SparkSession, src: str, root: str) -> DataFrame:
    """Batch load of the warehouse as the next published version of ``root``; returns the E5
    reconciliation. Readers see the version before until all tables are written, and a load
    that ends early changes nothing (``sources.published``). Facts hold the months of earlier
    loads that this one doesn't bring. All payment types are kept; readers choose."""
    wh, out = Warehouse(spark, src, lookups=False), Publication(spark, root)
    for name in ("dim_customer", "dim_product", "dim_seller", "dim_date"):
        out.add_table(getattr(wh, name), name)
    ok, bad = _staged_lines(wh, out.folder("_checked_lineitem"))
    out.add_table(bad, "rejects_lineitem")
    sales = out.add_fact(_loaded_sales(ok), "fact_sales", clustered=True)
    out.add_fact(W.fact_payments(standins.payments_source(wh.table("events")), wh.dim_customer), "fact_payments")
    latest = etl.latest_per_key(wh.table("orders"), ["o_orderkey"], ["o_orderdate"])
    out.add_fact(standins.orders_source(latest).withColumn("month_key", month_key("ordered_at")), "fact_orders")
    out.add_table(wh.ratings, "fact_ratings")
    result = out.add_table(_reconciled(spark, wh.table("lineitem"), ok, bad, sales), "reconciliation")
    remove_table(spark, out.folder("_checked_lineitem"))
    out.publish()
    return result


def load(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Batch load of the warehouse into plain tables under ``dst``, replaced in place (``load_version``
    keeps versions instead); returns the E5 reconciliation.

    Lines are checked once against orders, parts and suppliers
    (``Warehouse.checked_lines``); the flagged rows are written once, partitioned by
    outcome, so accepted and rejected rows come from a single pass.
    """
    wh = Warehouse(spark, src, lookups=False)
    for name in ("dim_customer", "dim_product", "dim_seller", "dim_date"):
        write_table(getattr(wh, name), os.path.join(dst, name))

    checked = os.path.join(dst, f"_checked_lineitem-{uuid.uuid4().hex[:12]}")  # this run's own; removed below
    ok, bad = _staged_lines(wh, checked)
    write_table(bad, os.path.join(dst, "rejects_lineitem"))

    sales = _loaded_sales(ok)
    write_fact(sales, os.path.join(dst, "fact_sales"), "month_key", clustered=True)
    pay = W.fact_payments(standins.payments_source(wh.table("events"), ["purchase"]), wh.dim_customer)
    write_fact(pay, os.path.join(dst, "fact_payments"), "month_key")
    write_table(wh.ratings, os.path.join(dst, "fact_ratings"))

    # only the months of this load: the fact may hold others from earlier ones
    months = sales.select(F.col("month_key").alias("_m")).distinct()
    fact = spark.read.parquet(os.path.join(dst, "fact_sales"))
    loaded = fact.join(months, fact.month_key.eqNullSafe(months["_m"]), "left_semi")
    write_table(_reconciled(spark, wh.table("lineitem"), ok, bad, loaded), os.path.join(dst, "reconciliation"))
    remove_table(spark, checked)
    return spark.read.parquet(os.path.join(dst, "reconciliation"))
