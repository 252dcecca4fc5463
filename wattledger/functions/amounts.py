"""Amounts and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import col


def credit_negative(sign: str | Column, amount: str | Column, credit: str = "CR") -> Column:
    """Credits count against, every other sign counts as it is."""
    return F.when(F.upper(col(sign)) == credit, -col(amount)).otherwise(col(amount))


def debit_or_credit(sign: str | Column, amount: str | Column,
                    debit: str = "DB", credit: str = "CR") -> Column:
    """Debits plus, credits minus, any other sign NULL."""
    return F.when(col(sign) == debit, col(amount)).when(col(sign) == credit, -col(amount))


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """``top / abs(bottom)``, NULL for a zero or missing bottom."""
    return F.try_divide(col(top), F.abs(col(bottom)))


def zero_as_null(count: str | Column) -> Column:
    """A count as text, with 0 shown as NULL."""
    return F.nullif(col(count), F.lit(0)).cast("string")


def default(value: str | Column, other) -> Column:
    return F.coalesce(col(value), F.lit(other))


def exceeds(value: str | Column, limit: str | Column) -> Column:
    """Value reaches a usable (positive) limit; NULL logic as in SQL."""
    return (col(value) >= col(limit)) & (col(limit) > 0)


def reconciles(left: str | Column, right: str | Column, tolerance: float) -> Column:
    return F.abs(F.coalesce(col(left), F.lit(0.0)) - F.coalesce(col(right), F.lit(0.0))) <= tolerance
