"""Two-level usage statistics per origin zone.

One job answers every year (and every weekend/season bucket): the year and
the bucket are grouping keys instead of a filter per year and per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import season_bucket, weekend_bucket
from ..operators.stats import add_relative_spread, extremes, summarise_counts, unit_counts
from ..operators.zoning import locate
from .data import TripData

STUDIES = ("all", "weekend", "season")


def zone_stats(
    data: TripData,
    study: str = "all",
    weekend_rule: str = "intended",
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Per year [and bucket] and origin zone: mean / sample std / min / max of the trips per
    weekday (``study='all'`` or ``'weekend'``) or per month (``'season'``), plus
    ``std_scaled``, ``spread``, ``mean_scaled`` and the zone centroid.

    A bucket without trips yields no rows (E5).
    """
    z = data.departures()
    if years is not None:
        z = z.filter(F.col("year").isin([int(y) for y in years]))
    if study == "all":
        groups, unit = ["year"], "dayofweek"
    elif study == "weekend":
        z = z.withColumn("bucket", weekend_bucket(F.col("dayofweek"), weekend_rule))
        groups, unit = ["year", "bucket"], "dayofweek"
    elif study == "season":
        z = z.withColumn("bucket", season_bucket(F.col("month")))
        groups, unit = ["year", "bucket"], "month"
    else:
        raise ValueError(f"unknown study {study!r}; expected one of {STUDIES}")
    stats = summarise_counts(unit_counts(z, groups, "zone", unit), groups, "zone")
    stats = add_relative_spread(stats, groups)
    return locate(stats, data.centroids(), "zone")


def zone_extremes(
    data: TripData,
    study: str = "all",
    weekend_rule: str = "intended",
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Zone(s) with the largest ``std_scaled`` and ``spread`` per year [and bucket]."""
    stats = zone_stats(data, study, weekend_rule, years)
    groups = ["year"] if study == "all" else ["year", "bucket"]
    return extremes(stats, groups, "zone", ("std_scaled", "spread"))
