"""Global order statistics without a one-partition window.

``row_number()`` / ``ntile()`` / a running ``sum`` over a window with no
``partitionBy`` moves every row into a single task. ``running_total``
computes the same numbers in parallel, by one algorithm at every size:

1. ``repartitionByRange`` on the whole ordering tuple, so that even one value
   that holds a third of the rows is spread by the tie-breaking columns; the
   partition's number is stored with the row and the result is checkpointed;
2. partition totals (one row per partition) give each partition's offset;
3. a window partitioned by that number finishes the running total inside each
   partition, and the offset is added.

The ranges only balance the work: any ranges give the exact result. Ordering
columns may be null (nulls first, as in a window) and should identify a row
(add a key as the last column) so that the order is total.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_BUCKETS = 8


def running_total(df: DataFrame, order: list[str], value: str | Column | None = None,
                  out: str = "_cum", rows_per_bucket: int = 1_000_000) -> tuple[DataFrame, int]:
    """Add ``out`` = inclusive running sum of ``value`` (default 1, i.e. the
    row number; a null value counts as 0) in ``order`` (ascending), in the type
    that ``sum`` of the value has. Returns (frame, row count).

    A count decides the number of ranges: one per ``rows_per_bucket`` rows, at
    least ``MIN_BUCKETS``, without an upper limit.
    """
    n = df.count()
    val = F.lit(1).cast("bigint") if value is None else (F.col(value) if isinstance(value, str) else value)
    kind = df.select(F.sum(val).alias("t")).schema["t"].dataType
    buckets = max(MIN_BUCKETS, math.ceil(n / max(1, rows_per_bucket)))
    d = (df.withColumn("_v", F.coalesce(val.cast(kind), F.lit(0).cast(kind)))
           .repartitionByRange(buckets, *order).withColumn("_b", F.spark_partition_id()).checkpoint(eager=True))
    # one row per range; the checkpoint keeps its small window out of the plan of the rows
    totals = d.groupBy("_b").agg(F.sum("_v").alias("_t"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_b", F.coalesce(F.sum("_t").over(before).cast(kind), F.lit(0).cast(kind)).alias("_off")) \
                    .checkpoint(eager=True)
    w = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    res = d.join(offsets, "_b").withColumn(out, (F.col("_off") + F.sum("_v").over(w)).cast(kind))
    return res.select(*df.columns, out) if out not in df.columns else res.select(*df.columns), n


def global_row_number(df: DataFrame, order: list[str], out: str = "_rank", **kw) -> tuple[DataFrame, int]:
    """1-based position of each row in ``order`` (ties must be broken by the caller)."""
    return running_total(df, order, None, out, **kw)


def ntile_of(rank: Column, n_rows: int, tiles: int) -> Column:
    """``ntile(tiles)`` for a 1-based ``rank`` among ``n_rows`` rows, with
    the same rule as SQL: the first ``n_rows % tiles`` tiles hold one row
    more."""
    q, rem = divmod(n_rows, tiles)
    big = rem * (q + 1)
    if q == 0:
        return rank.cast("int")
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
            .otherwise(F.floor((rank - big - 1) / q) + rem + 1).cast("int")


def null_safe_on(left: list[str], right: list[str]) -> Column:
    """Join condition that also matches null group keys with each other."""
    conds = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def exact_percentiles(df: DataFrame, by: list[str], value: str, ps: list[float],
                      out_type: str = "decimal(20,6)", **kw) -> DataFrame:
    """Exact interpolated percentiles (the ``percentile`` / ``percentile_cont``
    rule: position (n - 1) p between the two neighbouring values) of a decimal
    or integer ``value`` per ``by``, one column ``p<i>`` per entry of ``ps``.

    Distributed: rows are counted per (group, value) with a map-side combine,
    a parallel running count over (group, value) gives each distinct value
    its index range, and a conditional aggregate per group picks the values
    at the two neighbouring indices. No group is gathered into one task, and
    the interpolation is exact decimal arithmetic.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    cum, _ = running_total(counts, [*by, value], "_c", "_cum", **kw)
    # per-group start and size, as aggregates joined back on the group keys
    if by:
        groups = cum.groupBy(*[F.col(b).alias(f"_g_{b}") for b in by]).agg(
            F.min(F.col("_cum") - F.col("_c")).alias("_start"), F.sum("_c").alias("_n"))
        rows = cum.join(groups, null_safe_on(by, [f"_g_{b}" for b in by]), "inner") \
                  .drop(*[f"_g_{b}" for b in by])
    else:
        total = counts.agg(F.sum("_c")).first()[0]  # one number
        rows = cum.withColumn("_start", F.lit(0).cast("bigint")).withColumn("_n", F.lit(total).cast("bigint"))
    hi_excl = F.col("_cum") - F.col("_start")          # index after this value's last row
    lo_incl = hi_excl - F.col("_c")                    # index of this value's first row
    aggs = []
    for i, p in enumerate(ps):
        pos = (F.col("_n") - 1).cast("decimal(20,0)") * F.lit(Decimal(str(p)))
        lo_i, hi_i = F.floor(pos), F.ceil(pos)
        aggs.append(F.max(F.when((lo_incl <= lo_i) & (lo_i < hi_excl), F.col(value))).alias(f"_lo{i}"))
        aggs.append(F.max(F.when((lo_incl <= hi_i) & (hi_i < hi_excl), F.col(value))).alias(f"_hi{i}"))
        aggs.append(F.max(pos - lo_i).alias(f"_f{i}"))
    picked = rows.groupBy(*by).agg(*aggs)
    return picked.select(*by, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).cast(out_type).alias(f"p{i}")
        for i in range(len(ps))])
