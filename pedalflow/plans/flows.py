"""Flows between zones and stations.

Departures and arrivals are counted in one pass: each trip contributes one
row for its origin and one for its destination, and a single aggregate sums
both directions.  That replaces two aggregates joined afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import top_n
from ..operators.stats import minmax_scale
from ..operators.zoning import locate
from .data import TripData


def _both_directions(df: DataFrame, out_col: str, in_col: str, keys: Sequence[str]) -> DataFrame:
    """Rows ``(*keys, place, is_out, is_in)``: one per trip end (weighted by ``w`` if present)."""
    one = F.col("w") if "w" in df.columns else F.lit(1)
    ends = F.array(
        F.struct(F.col(out_col).alias("place"), one.cast("long").alias("is_out"), F.lit(0).cast("long").alias("is_in")),
        F.struct(F.col(in_col).alias("place"), F.lit(0).cast("long").alias("is_out"), one.cast("long").alias("is_in")),
    )
    return df.select(*keys, F.inline(ends))


def zone_balance(data: TripData, how: str = "inner", years: Sequence[int] | None = None) -> DataFrame:
    """Per year and zone: departures, arrivals, difference, its positive and negative part,
    and the zone centroid (L10, H8).

    ``how='inner'`` keeps zones with both departures and arrivals in that year
    (S10); ``how='full_outer'`` keeps every zone with 0 for a missing side.
    """
    z = data.cube if data.cube is not None else data.counted()
    if years is not None:
        z = z.filter(F.col("year").isin([int(y) for y in years]))
    if data.cube is None:
        # trips are summed per zone pair first; only those sums are turned into two ends
        pairs = z.groupBy("year", "origin_zone", "dest_zone").agg(F.sum("w").alias("w"))
        z = _both_directions(pairs, "origin_zone", "dest_zone", ["year"]).select(
            "year", F.col("place").alias("zone"), F.col("is_out").alias("n_out"), F.col("is_in").alias("n_in")
        )
    counts = z.groupBy("year", "zone").agg(
        F.sum("n_out").cast("long").alias("n_out"), F.sum("n_in").cast("long").alias("n_in")
    ).filter((F.col("n_out") > 0) | (F.col("n_in") > 0))
    if how == "inner":
        counts = counts.filter((F.col("n_out") > 0) & (F.col("n_in") > 0))
    elif how != "full_outer":
        raise ValueError(f"unknown how {how!r}")
    diff = F.col("n_out") - F.col("n_in")
    counts = counts.withColumns(
        {
            "difference": diff,
            "more_out": F.greatest(diff, F.lit(0)),
            "more_in": F.greatest(-diff, F.lit(0)),
        }
    )
    return locate(counts, data.centroids(), "zone")


def zone_balance_scaled(data: TripData, how: str = "inner") -> DataFrame:
    """``zone_balance`` plus min-max scaled ``more_out`` / ``more_in`` per year."""
    w = Window.partitionBy("year")
    return zone_balance(data, how).withColumns(
        {
            "more_out_scaled": minmax_scale(F.col("more_out"), w),
            "more_in_scaled": minmax_scale(F.col("more_in"), w),
        }
    )


def zone_balance_share(data: TripData, how: str = "inner") -> DataFrame:
    """Percentage use per zone and year (L20): share of the year's departures, arrivals and
    trip ends (departures + arrivals) that the zone accounts for."""
    w = Window.partitionBy("year")
    b = zone_balance(data, how)
    ends = F.col("n_out") + F.col("n_in")
    return b.select(
        "year",
        "zone",
        "n_out",
        "n_in",
        "difference",
        F.try_divide(100.0 * F.col("n_out"), F.sum("n_out").over(w)).alias("out_pct"),
        F.try_divide(100.0 * F.col("n_in"), F.sum("n_in").over(w)).alias("in_pct"),
        F.try_divide(100.0 * ends, F.sum(ends).over(w)).alias("usage_pct"),
    )


def zone_in_out_demand(data: TripData) -> DataFrame:
    """Arrivals and departures per zone over every trip.

    Each trip end is looked up on its own (a trip with one unmatched end still
    counts for the other).  Zones are those with arrivals; departures are NULL
    for a zone nobody leaves from, as the arrivals-left-join-departures did.
    """
    # Ends are counted per station first (map-side combined, one row per station), so
    # the zone lookup joins station totals, not trips, whatever the dimension size.
    ends = _both_directions(data.trips, "unplug_station", "plug_station", [])
    per_station = ends.groupBy(F.col("place").alias("station")).agg(
        F.sum("is_in").alias("arrivals"), F.sum("is_out").alias("departures")
    )
    counts = (
        per_station.join(data.station_lookup(), "station")
        .groupBy("zone")
        .agg(F.sum("arrivals").cast("long").alias("arrivals"), F.sum("departures").cast("long").alias("departures"))
    )
    return (
        counts.filter(F.col("arrivals") > 0)
        .select("zone", "arrivals", F.when(F.col("departures") > 0, F.col("departures")).alias("departures"))
        .orderBy("arrivals", "zone")
    )


def station_balance(data: TripData) -> DataFrame:
    """Per station: bikes taken (unplugs), bikes returned (plugs) and the difference, for
    stations seen at both ends (L15, C8)."""
    ends = _both_directions(data.trips, "unplug_station", "plug_station", [])
    counts = ends.groupBy(F.col("place").alias("station")).agg(
        F.sum("is_out").cast("long").alias("n_unplugs"),
        F.sum("is_in").cast("long").alias("n_plugs"),
    )
    return counts.filter((F.col("n_unplugs") > 0) & (F.col("n_plugs") > 0)).withColumn(
        "difference", F.col("n_unplugs") - F.col("n_plugs")
    )


def station_balance_top(data: TripData, n: int = 10) -> DataFrame:
    """Stations that lose most bikes: top ``n`` by unplugs - plugs, ties by station."""
    return top_n(station_balance(data), n, [F.desc("difference"), F.asc("station")])


def od_weekday_counts(data: TripData) -> DataFrame:
    """Trips per (start station, weekday, end station)."""
    return data.dated().groupBy("unplug_station", "dayofweek", "plug_station").agg(
        F.count(F.lit(1)).alias("n_trips")
    )


def od_weekday_top(data: TripData, n: int = 10) -> DataFrame:
    """Most frequent connections per weekday: top ``n`` station pairs x weekday."""
    return top_n(
        od_weekday_counts(data),
        n,
        [F.desc("n_trips"), F.asc("unplug_station"), F.asc("dayofweek"), F.asc("plug_station")],
    )


def busiest_destinations(data: TripData, n: int = 5) -> DataFrame:
    """The ``n`` end stations with most trips (ties by station)."""
    counts = data.trips.groupBy("plug_station").agg(F.count(F.lit(1)).alias("n_trips"))
    return top_n(counts, n, [F.desc("n_trips"), F.asc("plug_station")]).select("plug_station")


def od_selected_stations(data: TripData, stations: Sequence[int] | None = None, n: int = 5) -> DataFrame:
    """Start station x weekday x end station counts for trips ending at the chosen stations
    (B10, D5).  Without ``stations`` the ``n`` busiest end stations are used, as the study did.
    """
    dated = data.dated()
    if stations is not None:
        chosen = dated.filter(F.col("plug_station").isin(list(stations)))
    else:
        # n rows at most (a top-n), so the broadcast is bounded by construction.
        chosen = dated.join(F.broadcast(busiest_destinations(data, n)), "plug_station", "left_semi")
    return chosen.groupBy("unplug_station", "dayofweek", "plug_station").agg(F.count(F.lit(1)).alias("n_trips"))
