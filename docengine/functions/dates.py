"""Date and time expressions.  ``as_of`` is a parameter so that results repeat."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from docengine.functions.text import as_col


def moment(as_of: Column | str | dt.datetime | None) -> Column:
    """Timestamp column for ``as_of``; now when it is None."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def since(c: Column | str, days: int, as_of=None) -> Column:
    """Rolling window: not older than ``days`` before ``as_of``."""
    return as_col(c).cast("timestamp") >= moment(as_of) - F.make_dt_interval(F.lit(days))


def since_date(c: Column | str, days: int, as_of=None) -> Column:
    """Rolling window counted from the start of the day of ``as_of``."""
    start = F.date_sub(F.to_date(moment(as_of)), days)
    return as_col(c).cast("timestamp") >= start.cast("timestamp")


def hours_between(later: Column, earlier: Column) -> Column:
    """Whole seconds apart, in hours, unrounded."""
    gap = F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))
    return gap / F.lit(3600.0)


def parse_date(c: Column | str) -> Column:
    """Text to date; unreadable text is NULL, not an error.  '2024' and '2024-05' are read."""
    return as_col(c).try_cast("date")


def tag_value(tags: Column | str, key: str) -> Column:
    return as_col(tags)[key]


def tag_startswith(tags: Column | str, key: str, prefix: str) -> Column:
    return tag_value(tags, key).startswith(prefix)
