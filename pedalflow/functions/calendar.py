"""Calendar columns derived from a trip's local start date.

The trip text carries a UTC offset (``2017-06-01T00:30:00.000+0200``).  The
calendar date is taken from the text itself, never from the instant: turning
the text into a timestamp first would move trips just after midnight to the
previous day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import WEEKDAY_NAMES


def date_of_text(text: Column) -> Column:
    """Local calendar date of an ISO text such as ``2017-06-01T00:30:00.000+0200``.

    NULL (not a job failure under ANSI mode) when the text holds no valid date.
    """
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def _part(text: Column, n: int) -> Column:
    # n-th part (1-based) of the text split on ``T``; NULL when absent, even under ANSI mode.
    return F.try_element_at(F.split(text, "T"), F.lit(n))


def hour_of_text(text: Column) -> Column:
    """Local hour (0-23) of the same text; the part after ``T``."""
    return F.substring(_part(text, 2), 1, 2).try_cast("int")


def day_text(text: Column) -> Column:
    """Text before ``T`` (H6)."""
    return _part(text, 1)


def time_text(text: Column) -> Column:
    """Text after ``T`` (H6)."""
    return _part(text, 2)


def with_calendar(df: DataFrame, date_col: str = "trip_date", extended: bool = False) -> DataFrame:
    """Add ``dayofweek, month, weekofyear, year`` (L1) from a date column.

    ``dayofweek`` keeps Spark's numbering (1 = Sunday, S4); ``weekofyear`` is
    the ISO week while ``year`` is the calendar year (S8), so 1 January 2017 is
    week 52 of year 2017.  ``extended`` also adds ``dayofyear`` and
    ``dayofmonth`` (H2, H3).

    Columns already present are kept: trips stored partitioned by ``year`` and
    ``month`` keep those partition columns, so filters on them prune folders.
    """
    d = F.col(date_col)
    cols = {
        "dayofweek": F.dayofweek(d),
        "month": F.month(d),
        "weekofyear": F.weekofyear(d),
        "year": F.year(d),
    }
    if extended:
        cols["dayofyear"] = F.dayofyear(d)
        cols["dayofmonth"] = F.dayofmonth(d)
    return df.withColumns({k: v for k, v in cols.items() if k not in df.columns})


def weekday_name(dayofweek: Column) -> Column:
    """English weekday name for Spark's 1 = Sunday numbering."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.try_element_at(names, dayofweek)


def iso_weekday(date: Column) -> Column:
    """ISO weekday, 1 = Monday ... 7 = Sunday."""
    return F.weekday(date) + 1


def year_of_week(date: Column) -> Column:
    """ISO week-numbering year (the year the ISO week belongs to)."""
    # The Thursday of an ISO week always lies in the week's year.
    return F.year(F.date_add(date, 3 - F.weekday(date)))
