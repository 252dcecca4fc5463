"""Code and description texts such as ``4-Billed use``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def leading_code(text: str | Column) -> Column:
    """Signed number at the start of a text, blanks allowed; NULL when there is none.

    A split on the dash would turn ``-26-X`` into an empty string.
    """
    return F.regexp_extract(col(text), r"^\s*(-?[0-9]+)", 1).try_cast("int")


def token(text: str | Column, position: int, separator: str = "-") -> Column:
    """Token at a position, counted from 0; NULL past the end."""
    return F.get(F.split(col(text), separator), F.lit(position))


def token_is(text: str | Column, position: int, wanted: str, separator: str = "-") -> Column:
    """True when the token at that position equals ``wanted``; never NULL."""
    return F.coalesce(token(text, position, separator) == F.lit(wanted), F.lit(False))


def glue(*parts: str | Column) -> Column:
    """Concatenation where a NULL part counts as empty text.

    Plain strings are column names; wrap constants in ``F.lit``.
    """
    return F.concat(*[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])


def code_text(code: str | Column, text: str | Column, separator: str = "-") -> Column:
    """``code<separator>text`` of a matched lookup; NULL when the lookup found no row."""
    return F.when(col(code).isNotNull(), glue(col(code), F.lit(separator), col(text)))


def bare_code(code: str | Column, text: str | Column, bare: int = -1) -> Column:
    """As ``code_text``, but one special code is shown without its text."""
    return F.when(col(code) == bare, F.lit(str(bare))).otherwise(code_text(code, text))


def status_text(code: str | Column, names: dict[str, str], other: str) -> Column:
    """Text of a code from a short fixed list, with a default for the rest."""
    whole = reduce(lambda acc, kv: acc.when(col(code) == kv[0], kv[1]),
                   list(names.items())[1:],
                   F.when(col(code) == next(iter(names)), next(iter(names.values()))))
    return whole.otherwise(other)


def in_any(code: int | Column, *columns: str | Column) -> Column:
    """True when any of the columns holds the code; NULL columns count as no match."""
    wanted = F.lit(code) if not isinstance(code, Column) else code
    return F.when(wanted.isin(*[col(c) for c in columns]), True).otherwise(False)


def any_element(array: str | Column, test) -> Column:
    """True when some element passes; a missing array has none."""
    return F.coalesce(F.exists(col(array), test), F.lit(False))
