"""Per-year wide tables.

The studied code built a year-per-column table with one filtered aggregate per
year folded by N-1 inner joins; here it is one aggregate over all years, then
a pivot of that (small) aggregate.  ``how='inner'`` keeps only keys present in
every year, which is what the inner-join fold produced; ``how='outer'`` keeps
every key.

When the years are not given they are read from the aggregated counts, not
from the trips: the counts are written once to the shared checkpoint folder
(one row per key and year), so the trips are scanned a single time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .stats import trip_count


def distinct_years(df: DataFrame, year_col: str = "year") -> list[int]:
    """Sorted distinct years (L4).  Bounded result: one value per calendar year."""
    rows = df.select(year_col).where(F.col(year_col).isNotNull()).distinct().orderBy(year_col).collect()
    return [int(r[0]) for r in rows]


def year_counts(df: DataFrame, keys: Sequence[str], year_col: str = "year") -> DataFrame:
    """Long form: trips per key and year."""
    return (
        df.where(F.col(year_col).isNotNull())
        .groupBy(*keys, year_col)
        .agg(trip_count(df).alias("n_trips"))
    )


def pivot_years(
    df: DataFrame,
    keys: Sequence[str],
    years: Sequence[int] | None = None,
    how: str = "inner",
    year_col: str = "year",
) -> DataFrame:
    """Trip counts per key with one column per year (named ``"2017"``, ...)."""
    long = year_counts(df, keys, year_col)
    if years is None:
        ensure_checkpoint_dir(df.sparkSession)
        long = long.checkpoint(eager=True)
        years = distinct_years(long, year_col)
    else:
        years = [int(y) for y in years]
        long = long.filter(F.col(year_col).isin(years))
    wide = long.groupBy(*keys).pivot(year_col, list(years)).agg(F.sum("n_trips"))
    names = [str(y) for y in years]
    if how == "inner":
        cond = F.lit(True)
        for n in names:
            cond = cond & F.col(f"`{n}`").isNotNull()
        wide = wide.filter(cond)
    elif how != "outer":
        raise ValueError(f"unknown how {how!r}")
    return wide
