"""Calendar studies: trips per weekday / week and year, growth, daily peaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import weekday_name, year_of_week
from ..operators.ranking import pick_one
from ..operators.stats import trip_count
from ..operators.zoning import zone_trips
from ..operators.wide import pivot_years
from .data import TripData


def years(data: TripData) -> DataFrame:
    """Distinct years of the zoned trips (L4)."""
    return data.departures().select("year").distinct()


def random_zone(data: TripData, seed: int = 0) -> DataFrame:
    """A deterministic, seeded choice of origin zone."""
    return pick_one(data.departures(), "zone", seed)


def distinct_zone_count(data: TripData) -> DataFrame:
    """Distinct origin zones, destination zones and stations used by zoned trips."""
    # station ids are trip-level: always from the trips, never from a zone cube.  Trips
    # collapse to distinct (start, end) pairs, map-side, before the lookups and the counts.
    pairs = data.dated().select("unplug_station", "plug_station").distinct()
    z = zone_trips(pairs, data.station_lookup(), prepared=True)
    return z.agg(
        F.count_distinct("origin_zone").alias("n_origin_zones"),
        F.count_distinct("dest_zone").alias("n_dest_zones"),
        F.count_distinct("unplug_station").alias("n_origin_stations"),
        F.count_distinct("plug_station").alias("n_dest_stations"),
    )


def trips_by_weekday_year(
    data: TripData,
    zone: str | None = None,
    by_zone: bool = False,
    years: Sequence[int] | None = None,
    how: str = "inner",
    seed: int = 0,
) -> DataFrame:
    """Trips per weekday with one column per year, ordered by weekday.

    ``zone`` restricts to one origin zone (``zone="random"``: a seeded pick,
    applied as a semi-join so nothing is collected); ``by_zone`` answers every
    zone in the same job (zone becomes a key instead of one job per zone).
    """
    z = data.departures()
    if zone == "random":
        chosen = pick_one(z, "zone", seed)
        z = z.join(F.broadcast(chosen), "zone", "left_semi")  # one row
    elif zone is not None:
        z = z.filter(F.col("zone") == zone)
    keys = ["zone", "dayofweek"] if by_zone else ["dayofweek"]
    wide = pivot_years(z, keys, years, how)
    return wide.withColumn("weekday_name", weekday_name(F.col("dayofweek"))).orderBy(*keys)


def trips_by_week_year(
    data: TripData, years: Sequence[int] | None = None, how: str = "inner", year_basis: str = "calendar"
) -> DataFrame:
    """Trips per ISO week with one column per year, ordered by week.

    ``year_basis='calendar'`` pairs the ISO week with the calendar year, as the
    study did (1 January 2017 is week 52 of 2017, S8); ``'iso'`` uses the ISO
    week-numbering year instead (the same day is week 52 of 2016).
    """
    z = data.departures()
    if year_basis == "iso":
        z = z.withColumn("year", year_of_week(F.col("trip_date")))
    elif year_basis != "calendar":
        raise ValueError(f"unknown year basis {year_basis!r}")
    return pivot_years(z, ["weekofyear"], years, how).orderBy("weekofyear")


def growth_by_year(data: TripData) -> DataFrame:
    """Trips per calendar year of the text and their share of all trips.

    The share window runs over the per-year rows only (one row per year).
    """
    per_year = data.dated().groupBy("year").agg(F.count(F.lit(1)).alias("n_trips"))
    return per_year.withColumn("share", F.try_divide(F.col("n_trips"), F.sum("n_trips").over(Window.partitionBy())))


def _peak(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    best = F.max(
        F.struct(
            F.col("n_trips"),
            F.negative(F.unix_date("trip_date")).alias("neg_day"),
            F.col("trip_date"),
        )
    ).alias("best")
    return counts.groupBy(*keys).agg(best).select(
        *keys,
        F.col("best.n_trips").alias("max_daily_trips"),
        F.col("best.trip_date").alias("peak_date"),
    )


def daily_peak(data: TripData) -> DataFrame:
    """Largest number of trips on one day over trips with a known origin zone, and the
    earliest day reaching it (L14, D12)."""
    z = data.departures(known_dest=False)
    counts = z.groupBy("trip_date").agg(trip_count(z).alias("n_trips"))
    return _peak(counts, [])


def daily_peak_by_zone(data: TripData) -> DataFrame:
    """Per origin zone: the busiest day's trips and the earliest such day."""
    z = data.departures(known_dest=False)
    counts = z.groupBy("zone", "trip_date").agg(trip_count(z).alias("n_trips"))
    return _peak(counts, ["zone"])
