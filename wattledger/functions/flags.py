"""Flags with three values: true, false and "not known"."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import col


def unless_unset(setting, condition: Column) -> Column:
    """The condition, or NULL while its setting is not confirmed.

    ``false AND NULL`` is false, and a CASE with ELSE turns NULL into false; both
    would publish a "no" nobody measured.
    """
    if setting is None:
        return F.lit(None).cast("boolean")
    return condition


def or_unknown(value: str | Column, unknown: str) -> tuple[Column, Column]:
    """A key column without NULLs, and the flag that says where one stood."""
    return F.coalesce(col(value).cast("string"), F.lit(unknown)), col(value).isNull()


def any_signal(*flags: str | Column) -> Column:
    """True where at least one of the flags is true; NULL flags are no signal."""
    return reduce(lambda a, b: a | b, [F.coalesce(col(f), F.lit(False)) for f in flags])


def is_true(condition: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def matches(value: str | Column, wanted=None) -> Column:
    """Equality with a parameter, or any known value while the parameter is not given."""
    return col(value).isNotNull() if wanted is None else col(value) == F.lit(wanted)
