"""ETL operators: standardise (E2), latest row per key (E3), reject split
(E4) and reconciliation (E5). Reads are E1 (``sources.read_table``), loads
are E6 (``sources.write_fact``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_marts.functions.columns import MONEY, RATE, blank_to_null
from retail_marts.operators.skew import HotKeys, match_keys

# E2 ------------------------------------------------------------------------

_KINDS = {
    "text": lambda c: blank_to_null(c),
    "code": lambda c: F.upper(blank_to_null(c)),
    "money": lambda c: F.col(c).cast(MONEY),
    "rate": lambda c: F.col(c).cast(RATE),
    "long": lambda c: F.col(c).cast("bigint"),
    "int": lambda c: F.col(c).cast("int"),
    "timestamp": lambda c: F.col(c).cast("timestamp_ntz"),
    "date": lambda c: F.to_date(F.col(c)),
}


def standardise(df: DataFrame, spec: dict[str, str], rename: dict[str, str] | None = None) -> DataFrame:
    """Trim strings and turn blanks into null (``text``), also upper-case
    codes (``code``), cast money to decimal(18,2) (``money``) and rates to
    decimal(4,2) (``rate``). Columns not in ``spec`` pass through unchanged;
    ``rename`` maps old to new names. One projection, no shuffle.
    """
    unknown = set(spec) - set(df.columns)
    if unknown:
        raise ValueError(f"standardise: unknown columns {sorted(unknown)}")
    bad = {k for k in spec.values() if k not in _KINDS}
    if bad:
        raise ValueError(f"standardise: unknown kinds {sorted(bad)}")
    rename = rename or {}
    out = []
    for c in df.columns:
        e = _KINDS[spec[c]](c) if c in spec else F.col(c)
        out.append(e.alias(rename.get(c, c)))
    return df.select(*out)


# E3 ------------------------------------------------------------------------

def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep one row per ``keys``: the one with the largest ``order``
    values (compared left to right: latest first, then the tie breakers).
    Remaining ties are broken by the other columns, so the result never
    depends on row placement.

    Written as ``max(struct(order..., rest...))`` per key rather than
    ``row_number()`` over a window: the aggregate is combined map-side, so a
    key holding a large share of the rows is reduced inside every map task
    instead of being sorted by a single task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_m")
    best = df.groupBy(*keys).agg(F.max(packed).alias("_m"))
    return best.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in order + rest]).select(*df.columns)


# E4 ------------------------------------------------------------------------

@dataclass
class Parent:
    """A parent table a child column must point into (referential rule)."""

    name: str
    df: DataFrame
    on: dict[str, str]            # child column -> parent column
    reason: str = field(default="")

    def __post_init__(self):
        if not self.reason:
            self.reason = f"missing {self.name}"


def flag_rejects(df: DataFrame, rules: dict[str, Column] | None = None,
                 parents: list[Parent] | None = None,
                 first: dict[str, Column] | None = None,
                 hot: HotKeys | None = HotKeys(), spread: list[str] | None = None,
                 counted: DataFrame | None = None, settled: bool = True) -> DataFrame:
    """Add ``reject_reason``: null for an accepted row, else the first broken
    check (``first``, then parents, then rules, in the order given).
    ``first`` holds checks that must hold and are already resolved on
    ``df`` (e.g. a parent joined upstream for its attributes).

    A rule is a boolean column that must be true; null counts as broken. A
    child key that is null is *not* an orphan (it maps to the unknown member
    later); a non-null key with no parent row is. The keys that a parent lacks are found
    first (``skew.match_keys``, ``settled``): distinct keys are shuffled for it, the rows only
    where very many keys are missing. A parent with repeated keys cannot multiply child
    rows. ``hot``, ``spread``, ``counted`` and ``settled`` are passed on.
    """
    rules = rules or {}
    parents = parents or []
    reasons: list[Column] = [F.when(~F.coalesce(c, F.lit(False)), F.lit(name))
                             for name, c in (first or {}).items()]
    out = df
    for i, p in enumerate(parents):
        out = match_keys(out, p.df, p.on, f"_p{i}", hot=hot, spread=spread, counted=df if counted is None else counted, settled=settled)
        child_present = reduce(lambda a, b: a & b, [F.col(cc).isNotNull() for cc in p.on.keys()])
        reasons.append(F.when(child_present & F.col(f"_p{i}").isNull(), F.lit(p.reason)))
    for name, cond in rules.items():
        reasons.append(F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)))
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    return out.select(*df.columns, reason.cast("string").alias("reject_reason"))


def split_rejects(df: DataFrame, rules: dict[str, Column] | None = None,
                  parents: list[Parent] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Accepted has the input columns; rejected
    adds ``reject_reason``. Accepted + rejected = input, row for row.

    Both come from one flagged plan; a job that needs both should write the
    flagged rows once partitioned by outcome (see ``plans.warehouse``).
    """
    flagged = flag_rejects(df, rules, parents)
    ok = flagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = flagged.filter(F.col("reject_reason").isNotNull())
    return ok, bad


# E5 ------------------------------------------------------------------------

STAGES = ("source", "accepted", "rejected", "loaded")


def reconcile(tables: list[tuple[str, dict[str, DataFrame], str]]) -> DataFrame:
    """E5: one line per table with row counts and money totals of each stage
    (source, accepted, rejected, loaded) and ``balanced``: source = accepted
    + rejected and accepted = loaded, for rows and for money.

    ``tables`` holds (table name, {stage: DataFrame}, money column). Every
    stage is reduced to one row by a partial + final aggregate; the lines are
    put side by side with conditional sums, not joins.
    """
    parts = []
    for name, stages, money_col in tables:
        for stage in STAGES:
            d = stages.get(stage)
            if d is None:
                continue
            parts.append(d.agg(F.count(F.lit(1)).alias("n"),
                               F.coalesce(F.sum(F.col(money_col).cast(MONEY)),
                                          F.lit(0).cast(MONEY)).alias("amt"))
                         .select(F.lit(name).alias("table_name"), F.lit(stage).alias("stage"),
                                 "n", F.col("amt").cast(MONEY).alias("amt")))
    allp = reduce(DataFrame.unionByName, parts)
    aggs = []
    for stage in STAGES:
        aggs.append(F.sum(F.when(F.col("stage") == stage, F.col("n"))).cast("bigint").alias(f"{stage}_rows"))
        aggs.append(F.sum(F.when(F.col("stage") == stage, F.col("amt"))).cast(MONEY).alias(f"{stage}_amount"))
    out = allp.groupBy("table_name").agg(*aggs)
    bal = ((F.col("source_rows") == F.col("accepted_rows") + F.col("rejected_rows"))
           & (F.col("source_amount") == F.col("accepted_amount") + F.col("rejected_amount"))
           & (F.col("accepted_rows") == F.col("loaded_rows"))
           & (F.col("accepted_amount") == F.col("loaded_amount")))
    return out.withColumn("balanced", F.coalesce(bal, F.lit(False)))


@dataclass
class Compared:
    """A table and what was loaded of it: same columns, a key, and the month a row belongs to (``period``, yyyymm)."""

    name: str
    source: DataFrame
    loaded: DataFrame
    key: list[str]
    period: Column | None = None


def _prints(c: Compared, side: str, buckets: int) -> DataFrame:
    """One line per row: table, period (-1: none), key as text, bucket of the key, two 64-bit row hashes."""
    df = c.source if side == "source" else c.loaded
    cols = [F.col(x) for x in c.source.columns]
    absent = F.concat(*[F.when(x.isNull(), F.lit("0")).otherwise(F.lit("1")) for x in cols])  # a hash skips nulls
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in c.key])
    period = F.lit(-1) if c.period is None else F.coalesce(c.period.cast("int"), F.lit(-1))
    return df.select(F.lit(c.name).alias("table_name"), period.alias("period"), key.alias("key"),
                     F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"), F.lit(side).alias("side"),
                     F.xxhash64(absent, *cols).alias("h1"), F.xxhash64(F.lit("second"), absent, *cols).alias("h2"))


def _sums(prints: DataFrame, *by: str) -> DataFrame:
    """Rows and order-free fingerprints of both sides per ``by``: sums of row hashes, so repeated rows count."""
    def on(side, x):
        return F.sum(F.when(F.col("side") == side, x))
    out = prints.groupBy(*by).agg(*[
        F.coalesce(on(side, e), F.lit(0)).alias(f"{side}_{name}") for side in ("source", "loaded")
        for name, e in (("rows", F.lit(1).cast("bigint")), ("f1", F.col("h1").cast("decimal(20,0)")), ("f2", F.col("h2").cast("decimal(20,0)")))],
        F.min(F.when(F.col("side") == "source", F.col("period"))).alias("source_period"), F.min("period").alias("any_period"))
    unequal = [F.col(f"source_{x}") != F.col(f"loaded_{x}") for x in ("rows", "f1", "f2")]
    return out.where(unequal[0] | unequal[1] | unequal[2])


def reconcile_rows(tables: list[Compared], buckets: int = 256) -> DataFrame:
    """E5 by row: the keys whose rows differ between source and load, also where
    counts and sums agree.

    Level 1 sums row hashes per table, period and key bucket, one scan a side, all tables
    in one aggregate combined map-side. Level 2 returns only to the (period, bucket)
    cells that differ and sums per key, so no join of rows and no shuffle of what agrees.
    Row order doesn't matter, repeated rows count, a null differs from any value.

    Returns table_name, period (of the source's rows, else of the loaded ones; -1 without), key
    (parts joined by ``|``), difference (``missing``: fewer rows loaded, ``extra``: more,
    ``changed``), source_rows, loaded_rows (of the key in the cells that differ). Empty where all agree.
    """
    for c in tables:
        if c.source.dtypes != c.loaded.dtypes:
            raise ValueError(f"reconcile_rows: {c.name} differs in columns: {c.source.dtypes} and {c.loaded.dtypes}")
    prints = reduce(DataFrame.unionByName, [_prints(c, side, buckets) for c in tables for side in ("source", "loaded")])
    cell = ["table_name", "period", "bucket"]
    open_ = _sums(prints, *cell).select(*cell)
    rows = _sums(prints.join(open_, cell, "left_semi"), "table_name", "key")
    kind = (F.when(F.col("loaded_rows") < F.col("source_rows"), "missing")
            .when(F.col("loaded_rows") > F.col("source_rows"), "extra").otherwise("changed"))
    return rows.select("table_name", F.coalesce("source_period", "any_period").alias("period"), "key", kind.alias("difference"),
                       "source_rows", "loaded_rows")
