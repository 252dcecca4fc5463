"""Dates. "Today" is always an argument."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import col

# Fixed value: orders a series row that has no period end before all others.
NO_DATE = date(1900, 1, 1)
# Fixed value: the source writes this date for "never withdrawn".
NEVER_WITHDRAWN = date(4732, 12, 31)


def text_to_date(text: str | Column) -> Column:
    """Date of a ``YYYY-MM-DD`` text, with or without a time part; NULL when unreadable."""
    return col(text).cast("string").try_cast("date")


def day_text(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd")


def time_text(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss")


def year_month(year: str | Column, month: str | Column) -> Column:
    """``YYYY-MM``; NULL when either part is missing."""
    return F.concat(col(year).cast("string"), F.lit("-"),
                    F.lpad(col(month).cast("string"), 2, "0"))


def days_rounded(start: str | Column, end: str | Column) -> Column:
    """Days between two times, rounded to whole days."""
    return F.round((F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))) / 86400).cast("long")


def window_days(start: str | Column, end: str | Column) -> Column:
    """Whole days from start to end; NULL when an end is missing."""
    return F.datediff(col(end), col(start))


def since_months(ts: str | Column, as_of: date, months: int) -> Column:
    """True from the day that lies ``months`` months before ``as_of``."""
    return col(ts).cast("date") >= F.add_months(F.lit(as_of), -months)


def active_on(withdrawn: str | Column, as_of: date) -> Column:
    return col(withdrawn).isNull() | (text_to_date(withdrawn) > F.lit(as_of))


def is_never(withdrawn: str | Column, never: date = NEVER_WITHDRAWN) -> Column:
    return text_to_date(withdrawn) == F.lit(never)


def in_window(ts: str | Column, start: str | Column, end: str | Column,
              open_end: Column | date | None = None) -> Column:
    """``start <= ts <= end``, where a missing end is replaced by ``open_end`` if given."""
    stop = col(end)
    if open_end is not None:
        stop = F.coalesce(stop, open_end if isinstance(open_end, Column) else F.lit(open_end))
    return col(ts).between(col(start), stop)
