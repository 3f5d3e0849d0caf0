"""Key resolution that a hot key doesn't slow down.

A left join of many child rows against a parent's keys sends all rows of one key
to one task. AQE can't split that task where an aggregate stands between the
shuffle and the join, which is so for a parent made distinct. ``match_keys``
takes two paths in one pass over the child:

1. ``heavy_keys`` finds the keys that hold more than ``share`` of the rows, by a
   frequent-items sketch (``approx_top_k``): one aggregate with a bounded state
   per task, at most ``k`` keys as result. A key above the sketch's error (well
   below ``share``) is always listed; a listed key that isn't hot costs nothing.
2. Rows of a hot key are resolved by a broadcast side table of those keys, at most
   ``k`` rows by construction.
3. The other rows are joined by shuffle. Hot rows and rows with a null key take
   part in that join under a number drawn from the row itself, which no parent
   has, so they are spread over all tasks and match nothing.

All this is lazy and declarative: each side is unique on its key, so a query
that doesn't use the result loses joins and sketch alike.

Where the result is used for certain, ``settled=True`` asks first which keys of the child the
parent lacks. Only distinct keys cross the shuffle for that, whatever the rows' width. The keys
missing are few in sound data: without any there is no join left, up to ``few`` of them are broadcast,
and with more the rows take the two paths above.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HotKeys:
    """``share``: of the rows, above which a key is hot. ``k``: most keys listed (at least 1 / share).
    ``tracked``: counters of the sketch. ``ways``: numbers that bypassing rows are spread over.
    ``few``: most missing keys that are broadcast (``settled``)."""

    share: float = 0.005
    k: int = 256
    tracked: int = 8192
    ways: int = 4096
    few: int = 100_000

    def __post_init__(self):
        if self.k * self.share < 1.0:
            raise ValueError("k must be at least 1 / share: that many keys can be hot")
        if self.tracked < self.k:
            raise ValueError("the sketch must track at least k keys")


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def _one_value(cols: list[str]) -> Column:
    """One column that identifies the key: itself, or the key's parts as JSON."""
    return F.col(cols[0]) if len(cols) == 1 else F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)]))


def heavy_keys(df: DataFrame, keys: list[str], hot: HotKeys = HotKeys()) -> DataFrame:
    """(item, rows): at most ``hot.k`` keys that may hold over ``hot.share`` of the rows, with their
    estimated row counts. ``item`` is the key column, or the JSON of a key of several. Null keys aren't listed."""
    given = df.where(_all([F.col(c).isNotNull() for c in keys])).select(_one_value(keys).alias("item"))
    top = given.agg(F.call_function("approx_top_k", F.col("item"), F.lit(hot.k), F.lit(hot.tracked)).alias("t"), F.count(F.lit(1)).alias("n"))
    return (top.select(F.explode("t").alias("t"), "n").where(F.col("t.count") > F.col("n") * hot.share)
            .select(F.col("t.item").alias("item"), F.col("t.count").alias("rows")))


def missing_keys(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """The distinct keys of ``child`` (none with a null part) that ``parent`` lacks."""
    names = [f"_m{i}" for i in range(len(on))]
    keys = child.where(_all([F.col(c).isNotNull() for c in on])).select(*[F.col(c).alias(n) for c, n in zip(on, names)]).distinct()
    theirs = parent.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(on.values())])
    return keys.join(theirs, _all([F.col(n) == F.col(f"_k{i}") for i, n in enumerate(names)]), "left_anti")


def match_keys(child: DataFrame, parent: DataFrame, on: dict[str, str], hit: str = "_hit", value: str | None = None,
               hot: HotKeys | None = HotKeys(), spread: list[str] | None = None, counted: DataFrame | None = None,
               settled: bool = False, stored: bool = True) -> DataFrame:
    """``child`` with one more column: ``hit``, true where ``parent`` has the key (else null), or
    with ``value`` the greatest value of that parent column under the key.

    ``on`` maps child to parent columns; a key with a null part matches nothing. The child keeps
    exactly its rows. ``spread`` names the columns that tell rows of one key apart (default: all);
    ``counted`` is a frame with the child's key columns that is cheaper to count hot keys in (the
    table the child was derived from); ``hot=None`` joins plainly. ``settled`` (without ``value``) finds the
    missing keys now, in the same frame; the plan reads what was found, or with ``stored=False`` only its size
    decides and the plan finds them itself.
    """
    if settled and value is None:
        missing = missing_keys(child if counted is None else counted, parent, on)
        found = missing.checkpoint(eager=True)
        n, present = found.count(), _all([F.col(c).isNotNull() for c in on])
        if n == 0 and stored:
            return child.withColumn(hit, F.when(present, F.lit(True)))
        if n <= (hot or HotKeys()).few:
            gone = F.broadcast((found if stored else missing).withColumn("_gone", F.lit(True)))
            out = child.join(gone, _all([F.col(c) == F.col(f"_m{i}") for i, c in enumerate(on)]), "left")
            return out.select(*child.columns, F.when(present & F.col("_gone").isNull(), F.lit(True)).alias(hit))
    mine, theirs = list(on), list(on.values())
    names = [f"_k{i}" for i in range(len(on))]
    present = parent.where(_all([F.col(c).isNotNull() for c in theirs])).select(
        *[F.col(c).alias(n) for c, n in zip(theirs, names)], (F.lit(True) if value is None else F.col(value)).alias("_v"))
    side = present.groupBy(*names).agg(F.max("_v").alias("_cold"))
    same = _all([F.col(c) == F.col(n) for c, n in zip(mine, names)])
    if hot is None:
        return child.join(side, same, "left").select(*child.columns, F.col("_cold").alias(hit))
    listed = heavy_keys(child if counted is None else counted, mine, hot)
    found = present.withColumn("_item", _one_value(names)).join(F.broadcast(listed.select(F.col("item").alias("_item"))), "_item", "left_semi")
    # at most k rows: the listed keys, orphans among them included
    few = (listed.select(F.col("item").alias("_item")).join(F.broadcast(found.groupBy("_item").agg(F.max("_v").alias("_v"))), "_item", "left")
           .groupBy("_item").agg(F.max("_v").alias("_warm"), F.lit(True).alias("_listed")))
    flagged = child.join(F.broadcast(few), _one_value(mine) == F.col("_item"), "left")
    past = F.col("_listed") | ~_all([F.col(c).isNotNull() for c in mine])
    way = F.when(F.coalesce(past, F.lit(False)), F.pmod(F.xxhash64(*(spread or child.columns)), F.lit(hot.ways)) + 1).otherwise(0)
    # zero, as an expression of the row: a literal would be folded away and the number with it
    side = present.groupBy(*names, F.pmod(F.xxhash64(*names), F.lit(1)).cast("bigint").alias("_zero")).agg(F.max("_v").alias("_cold"))
    joined = flagged.withColumn("_way", way.cast("bigint")).join(side, same & (F.col("_way") == F.col("_zero")), "left")
    return joined.select(*child.columns, F.coalesce("_warm", "_cold").alias(hit))
