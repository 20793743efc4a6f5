"""Calendar helpers: year / month extraction, decades and anchored windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_date(c) -> Column:
    """``yyyy-mm-dd`` text as a date; anything else, and an impossible month or day, is NULL."""
    c = F.trim(_c(c))
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), c.try_cast("date"))


def year_of(c, text: bool = False) -> Column:
    """Year of a date/timestamp column as int.

    With ``text=True`` the input is ``yyyy-mm-dd`` text, read as a date first
    (bad text -> NULL instead of an ANSI error).
    """
    return F.year(text_date(c) if text else _c(c))


def month_of(c, text: bool = False) -> Column:
    """Month (1-12) of a date column as int; ``text=True`` reads ``yyyy-mm-dd``."""
    return F.month(text_date(c) if text else _c(c))


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def year_in(df: DataFrame, date: str) -> Column:
    """Year of ``df[date]``: a date/timestamp column, or ``yyyy-mm-dd`` text as
    a stored table may keep it."""
    return year_of(date, text=_is_text(df, date))


def month_in(df: DataFrame, date: str) -> Column:
    """Month of ``df[date]`` (date or ``yyyy-mm-dd`` text)."""
    return month_of(date, text=_is_text(df, date))


def decade_start(year) -> Column:
    """Calendar decade as int: 1994 -> 1990 (floor semantics, int result)."""
    y = _c(year)
    return (y - F.pmod(y, F.lit(10))).cast("int")


def decade_label(year) -> Column:
    """Decade label ``start-(start+10)``, e.g. 1990 -> ``1990-2000``."""
    s = decade_start(year)
    return F.concat(s.cast("string"), F.lit("-"), (s + 10).cast("string"))


def window_start(year, anchor, width: int = 10) -> Column:
    """Start of the ``width``-year window holding ``year``, windows anchored
    at ``anchor`` (a Column, e.g. a scalar subquery for the earliest year)."""
    y = _c(year)
    a = _c(anchor) if not isinstance(anchor, int) else F.lit(anchor)
    # anchor + floor((y - anchor) / width) * width, in integers, with the
    # anchor referenced once (it is usually a scalar subquery).
    return (y - F.pmod(y - a, F.lit(width))).cast("int")


def window_label(start, width: int = 10) -> Column:
    """Window label ``start-(start+width-1)``, e.g. 1902 -> ``1902-1911``."""
    s = _c(start)
    return F.concat(s.cast("string"), F.lit("-"), (s + (width - 1)).cast("string"))
