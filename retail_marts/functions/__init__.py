"""Column expressions shared by the operators (all built-in, JVM-side)."""

from retail_marts.functions.columns import (
    MONEY, RATE, UNKNOWN_KEY, blank_to_null, date_key, dim_key, money, month_key, month_start,
    rate, ratio, to_day,
)

__all__ = ["MONEY", "RATE", "UNKNOWN_KEY", "blank_to_null", "date_key", "dim_key", "money",
           "month_key", "month_start", "rate", "ratio", "to_day"]
