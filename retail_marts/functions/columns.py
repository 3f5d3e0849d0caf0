"""Reusable ``Column`` expressions.

Everything here is a built-in Spark expression, so it stays inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the model.
MONEY = T.DecimalType(18, 2)   # every money value has at most 2 decimals
RATE = T.DecimalType(4, 2)     # discount and tax rates
UNKNOWN_KEY = "-1"             # dimension key of the unknown member


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Money as an exact decimal(18,2); sums of it are exact in any order."""
    return _c(c).cast(MONEY)


def rate(c: str | Column) -> Column:
    return _c(c).cast(RATE)


def blank_to_null(c: str | Column) -> Column:
    """Trim; an empty result becomes null."""
    t = F.trim(_c(c))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def dim_key(*cols: str | Column) -> Column:
    """Dimension key = SHA-256 hex of the natural key parts joined by '|'.

    A null part gives the unknown key rather than a hash (``concat_ws`` skips
    nulls, so (a, null) and (null, a) would otherwise collide).
    """
    parts = [_c(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [p.isNull() for p in parts])
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.when(any_null, F.lit(UNKNOWN_KEY)).otherwise(F.sha2(text, 256))


def to_day(c: str | Column) -> Column:
    """Calendar day of a timestamp_ntz / date."""
    return F.to_date(_c(c))


def date_key(c: str | Column) -> Column:
    """yyyymmdd as int."""
    d = to_day(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(c: str | Column) -> Column:
    """yyyymm as int (the fact partition column)."""
    d = to_day(c)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def month_start(c: str | Column) -> Column:
    return F.trunc(to_day(c), "month")


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; null when the base is null or zero.

    Both sides are cast to double once and divided once, so the result is
    the same IEEE value in any engine.
    """
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(n / d)
