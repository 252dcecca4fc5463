"""Free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import col

# Line feed, carriage return, tab and the pipe sign are dropped.
DROPPED = "\n\r\t|"


def clean(text: str | Column) -> Column:
    """The whole text without line breaks, tabs and pipes."""
    return F.translate(col(text), DROPPED, "")


def drawn_from(text: str | Column, prefix: str | None = None, part: str | None = None,
               pattern: str | None = None) -> Column:
    """Prefix, contained text and pattern conditions, joined by AND."""
    cond = F.lit(True)
    if prefix is not None:
        cond = cond & col(text).startswith(prefix)
    if part is not None:
        cond = cond & col(text).contains(part)
    if pattern is not None:
        cond = cond & col(text).rlike(pattern)
    return cond
