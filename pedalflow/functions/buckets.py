"""Bucket columns that replace repeated filters.

One bucket column lets a single aggregation serve every bucket instead of one
job per filter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SEASONS, WEEKEND_AS_CODED_MIN_DAY, WEEKEND_DAYS


def weekend_bucket(dayofweek: Column, rule: str = "intended") -> Column:
    """``'weekend'`` or ``'weekday'``.

    ``rule='intended'``: Friday, Saturday, Sunday are the weekend.
    ``rule='as_coded'``: ``dayofweek >= 4`` (Wednesday-Saturday), as the analysis coded it.
    """
    if rule == "intended":
        is_weekend = dayofweek.isin(WEEKEND_DAYS)
    elif rule == "as_coded":
        is_weekend = dayofweek >= WEEKEND_AS_CODED_MIN_DAY
    else:
        raise ValueError(f"unknown weekend rule {rule!r}")
    return F.when(dayofweek.isNull(), None).when(is_weekend, "weekend").otherwise("weekday")


def season_bucket(month: Column) -> Column:
    """Season name for a month number (spring 3-6, summer 7-9, autumn 10-12, winter 1-2)."""
    expr = None
    for name, lo, hi in SEASONS:
        cond = month.between(lo, hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr
