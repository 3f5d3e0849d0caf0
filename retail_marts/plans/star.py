"""The data side of an interactive dashboard.

A ``StarModel`` names the measures and attributes of one fact and its
dimensions; ``slice`` turns a request (measures, attributes, filters, sort,
limit) into a DataFrame plan built from ``Column`` objects - no SQL text is
assembled, and a name outside the model raises ``UnknownName``. Only the
dimensions a request touches are joined, so Catalyst sees the smallest plan:
filters reach the Parquet scans and unused columns are pruned.

A ``Measure`` says how it is put together from parts (sums and counts add up, a
mean is a sum over a count, a distinct count needs its rows). Where all measures of
a request add up, the fact is summed by its keys first and the dimensions
join the sums; ``plans.lattice`` stores such sums.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_marts.functions.columns import month_start, ratio


class UnknownName(KeyError):
    """A measure, attribute, operator or sort key that the model does not define."""


@dataclass
class Dimension:
    df: DataFrame
    fact_key: str | tuple[str, ...]      # key column(s) on the fact
    key: str | tuple[str, ...]           # key column(s) on the dimension

    @property
    def pairs(self) -> list[tuple[str, str]]:
        """(fact column, dimension column)"""
        many = lambda k: (k,) if isinstance(k, str) else k
        return list(zip(many(self.fact_key), many(self.key)))


@dataclass(frozen=True)
class Measure:
    """``kind``: sum, count, mean or distinct; ``type``: of a sum's result."""

    kind: str
    column: str | None = None
    type: str = "decimal(18,2)"

    @property
    def additive(self) -> bool:
        return self.kind != "distinct"

    def __call__(self) -> Column:
        """The measure straight from the fact's rows."""
        if self.kind == "distinct":
            return F.countDistinct(self.column)
        if self.kind == "mean":
            return ratio(F.sum(self.column), F.count(self.column))
        return F.count(F.lit(1)) if self.kind == "count" else F.sum(self.column).cast(self.type)

    def parts(self, name: str) -> list[Column]:
        """What is stored of it for a group of rows."""
        if self.kind == "mean":
            return [F.sum(self.column).alias(f"{name}__sum"), F.count(self.column).alias(f"{name}__n")]
        return [self().alias(name)]

    def again(self, name: str) -> list[Column]:
        """The parts of several groups as those of one."""
        if self.kind == "mean":
            return [F.sum(f"{name}__sum").alias(f"{name}__sum"), F.sum(f"{name}__n").alias(f"{name}__n")]
        return [self.merged(name).alias(name)]

    def merged(self, name: str) -> Column:
        """The measure from its parts."""
        if self.kind == "mean":
            return ratio(F.sum(f"{name}__sum"), F.sum(f"{name}__n"))
        total = F.sum(name).cast("bigint" if self.kind == "count" else self.type)
        return F.coalesce(total, F.lit(0).cast("bigint")) if self.kind == "count" else total


@dataclass
class StarModel:
    fact: DataFrame
    dims: dict[str, Dimension] = field(default_factory=dict)
    # measure name -> Measure, or any aggregate expression
    measures: dict[str, Measure | Callable[[], Column]] = field(default_factory=dict)
    # attribute name -> (dimension name or None for the fact, expression)
    attributes: dict[str, tuple[str | None, Callable[[], Column]]] = field(default_factory=dict)


_OPS: dict[str, Callable[[Column, object], Column]] = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
    "not in": lambda c, v: ~c.isin(list(v)),
    "between": lambda c, v: c.between(v[0], v[1]),
    "is null": lambda c, v: c.isNull(),
    "is not null": lambda c, v: c.isNotNull(),
}


def slice(model: StarModel, measures: list[str], by: list[str],
          where: list[tuple] | None = None, order: list[tuple[str, str]] | None = None,
          n: int | None = None) -> DataFrame:
    """Aggregate ``measures`` by the attributes ``by`` over the rows that pass
    ``where`` (a list of (attribute, op, value)), sorted by ``order`` (a list
    of (output column, 'asc' | 'desc')), at most ``n`` rows.

    The output columns of ``by`` break any remaining tie, so a limited
    result is the same on every run.
    """
    where, order = where or [], order or []
    check(model, measures, by, where, order)
    asked = list(dict.fromkeys([*by, *[w[0] for w in where]]))
    used = sorted({model.attributes[a][0] for a in asked} - {None})
    own = [a for a in asked if model.attributes[a][0] is None]
    tests = {a: [(op, v) for x, op, *v in where if x == a] for a in asked}

    def passes(df: DataFrame, attrs: list[str]) -> DataFrame:
        conds = [_OPS[op](F.col(f"_a_{a}"), v[0] if v else None) for a in attrs for op, v in tests[a]]
        return df.filter(reduce(lambda x, y: x & y, conds)) if conds else df

    df = passes(model.fact.withColumns({f"_a_{a}": model.attributes[a][1]() for a in own}) if own else model.fact, own)
    early = used and all(isinstance(model.measures[m], Measure) and model.measures[m].additive for m in measures)
    if early:  # one row per key of the used dimensions and own attribute, then the joins
        keys = list(dict.fromkeys([k for n in used for k, _ in model.dims[n].pairs]))
        df = df.groupBy(*keys, *[f"_a_{a}" for a in own]).agg(*[c for m in measures for c in model.measures[m].parts(m)])
    for name in used:
        d = model.dims[name]
        attrs = [a for a in asked if model.attributes[a][0] == name]
        right = d.df.select(*[F.col(k).alias(f"_{name}_key{i}") for i, (_, k) in enumerate(d.pairs)],
                            *[model.attributes[a][1]().alias(f"_a_{a}") for a in attrs])
        on = reduce(lambda x, y: x & y, [F.col(f) == F.col(f"_{name}_key{i}") for i, (f, _) in enumerate(d.pairs)])
        # a filter on the dimension makes the join an inner one, which prunes the fact's partitions;
        # "is null" is also met by rows without a member, so alone it is tested after the join
        if any(op != "is null" for a in attrs for op, _ in tests[a]):
            df = df.join(passes(right, attrs), on, "inner")
        else:
            df = passes(df.join(right, on, "left"), attrs)
    out = df.groupBy(*[F.col(f"_a_{a}").alias(a) for a in by]).agg(
        *[(model.measures[m].merged(m) if early else model.measures[m]()).alias(m) for m in measures])
    return ranked(out, by, order, n)


def check(model: StarModel, measures: list[str], by: list[str], where: list[tuple], order: list[tuple[str, str]]) -> None:
    """Raise ``UnknownName`` for anything a request names that the model doesn't define."""
    for m in measures:
        if m not in model.measures:
            raise UnknownName(f"unknown measure {m!r}")
    for a in list(by) + [w[0] for w in where]:
        if a not in model.attributes:
            raise UnknownName(f"unknown attribute {a!r}")
    for w in where:
        if w[1] not in _OPS:
            raise UnknownName(f"unknown operator {w[1]!r}")
    outputs = set(measures) | set(by)
    for o, direction in order:
        if o not in outputs:
            raise UnknownName(f"sort key {o!r} is not an output column")
        if direction not in ("asc", "desc"):
            raise UnknownName(f"unknown direction {direction!r}")


def ranked(out: DataFrame, by: list[str], order: list[tuple[str, str]], n: int | None) -> DataFrame:
    sort = [F.col(o).desc() if d == "desc" else F.col(o).asc() for o, d in order]
    sort += [F.col(a).asc() for a in by if a not in [o for o, _ in order]]
    if sort:
        out = out.orderBy(*sort)
    return out if n is None else out.limit(n)


def _by_date(name: str) -> dict:
    """Calendar attributes of the date dimension."""
    return {k: (name, lambda k=k: F.col(k)) for k in ("year", "quarter", "month", "iso_week", "weekday")}


def _dims(wh, date_key: str) -> dict[str, Dimension]:
    """The conformed dimensions. Facts are partitioned by month, so the month joins the date's key:
    a filter on the calendar prunes partitions at run time."""
    return {"customer": Dimension(wh.dim_customer, "customer_key", "customer_key"),
            "date": Dimension(wh.dim_date, (date_key, "month_key"), ("date_key", "month_key"))}


_CUSTOMER = {"region": ("customer", lambda: F.col("region")),
             "nation": ("customer", lambda: F.col("nation")),
             "segment": ("customer", lambda: F.col("segment"))}


def sales_model(wh) -> StarModel:
    """The sales star of a ``Warehouse``."""
    return StarModel(
        fact=wh.sales,
        dims={**_dims(wh, "order_date_key"),
              "product": Dimension(wh.dim_product, "product_key", "product_key"),
              "seller": Dimension(wh.dim_seller, "seller_key", "seller_key")},
        measures={"net_revenue": Measure("sum", "net_amount"),
                  "gross_revenue": Measure("sum", "gross_amount"),
                  "discount": Measure("sum", "discount_amount"),
                  "tax": Measure("sum", "tax_amount"),
                  "units": Measure("sum", "quantity"),
                  "lines": Measure("count"),
                  "orders": Measure("distinct", "order_id")},
        attributes={"order_year": (None, lambda: F.year("ordered_at")),
                    "order_month": (None, lambda: month_start("ordered_at")),
                    "order_status": (None, lambda: F.col("order_status")),
                    "return_flag": (None, lambda: F.col("return_flag")),
                    "line_status": (None, lambda: F.col("line_status")),
                    **_CUSTOMER, **_by_date("date"),
                    "brand": ("product", lambda: F.col("brand")),
                    "product_type": ("product", lambda: F.col("product_type")),
                    "size": ("product", lambda: F.col("size")),
                    "seller_region": ("seller", lambda: F.col("region")),
                    "seller_nation": ("seller", lambda: F.col("nation"))},
    )


def payments_model(wh, only_types: list[str] | None = None) -> StarModel:
    """The payments star."""
    return StarModel(
        fact=wh.payments(only_types), dims=_dims(wh, "date_key"),
        measures={"payments": Measure("count"), "amount": Measure("sum", "amount"), "mean_amount": Measure("mean", "amount"),
                  "customers": Measure("distinct", "customer_id")},
        attributes={"payment_type": (None, lambda: F.col("payment_type")), **_CUSTOMER, **_by_date("date")})


def ratings_model(wh) -> StarModel:
    """The satisfaction star: a rating carries its own attributes (the sources have no customer or date for it)."""
    return StarModel(
        fact=wh.ratings, dims={},
        measures={"ratings": Measure("count"), "mean_score": Measure("mean", "score"), "satisfied": Measure("sum", "satisfied", "bigint"),
                  "satisfied_rate": Measure("mean", "satisfied"), "words": Measure("sum", "comment_words", "bigint")},
        attributes={"lang": (None, lambda: F.col("lang")), "source": (None, lambda: F.col("source")), "score": (None, lambda: F.col("score")),
                    "comment_words": (None, lambda: F.col("comment_words"))})


def customers_model(wh) -> StarModel:
    """The customer star: one row per customer with what the customer has ordered."""
    per = (wh.orders.where("customer_id IS NOT NULL").groupBy("customer_id")
           .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("order_value").cast("decimal(18,2)")).cast("decimal(18,2)").alias("order_value")))
    fact = (wh.dim_customer.where("customer_id IS NOT NULL").join(per, "customer_id", "left")
            .withColumn("n_orders", F.coalesce("n_orders", F.lit(0).cast("bigint"))))
    loyalty = lambda: F.when(F.col("n_orders") == 0, "none").when(F.col("n_orders") == 1, "one").otherwise("repeat")
    return StarModel(
        fact=fact, dims={},
        measures={"customers": Measure("count"), "orders": Measure("sum", "n_orders", "bigint"), "order_value": Measure("sum", "order_value"),
                  "mean_orders": Measure("mean", "n_orders"), "balance": Measure("sum", "acct_balance")},
        attributes={**{a: (None, lambda a=a: F.col(a)) for a in ("region", "nation", "segment")}, "loyalty": (None, loyalty)})
