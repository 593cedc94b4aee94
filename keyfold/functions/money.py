"""Exact money arithmetic: decimals, and averages rounded in integer cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(col: Column) -> Column:
    """A double amount as decimal(18,2) (rounded half up to the cent)."""
    return col.cast(MONEY)


def money_sum(col: Column) -> Column:
    return F.sum(money(col)).cast(MONEY)


def cents(col: Column) -> Column:
    return (money(col) * 100).cast("long")


def avg_money(col: Column) -> Column:
    """Mean rounded half up to the cent, computed exactly in integer cents."""
    total = F.sum(cents(col))
    n = F.count(col)
    rounded = F.floor((total * 2 + n) / (n * 2))
    return (rounded / F.lit(100)).cast(MONEY)
