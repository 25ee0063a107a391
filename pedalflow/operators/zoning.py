"""Map stations to zones and zones to coordinates.

* ``station_map``: one row per station number (suffixed siblings collapse to
  their number; they always share a zone, the smallest name is kept).
* ``zone_centroids``: one row per zone with the mean coordinate and the number
  of original station rows ``n_stations`` (S2, S3).  Joining coordinates per
  zone instead of per station row keeps every trip exactly once.
* ``zone_trips``: trips with ``origin_zone`` / ``dest_zone``.  The station map
  is broadcast when its size is proven small, so the trip side is never
  shuffled for the lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .broadcast import bounded_broadcast
from .stats import trip_count


def station_map(stations: DataFrame) -> DataFrame:
    """Station number -> zone.  A station without a zone is as good as unknown: its trips
    are lost rows on every path (the zone joins never matched them)."""
    return (
        stations.filter(F.col("station").isNotNull() & F.col("zone").isNotNull())
        .groupBy("station")
        .agg(F.min("zone").alias("zone"))
    )


def zone_centroids(stations: DataFrame) -> DataFrame:
    return stations.filter(F.col("zone").isNotNull()).groupBy("zone").agg(
        F.avg("lat").alias("lat"),
        F.avg("lon").alias("lon"),
        F.count(F.lit(1)).alias("n_stations"),
    )


def zone_trips(trips: DataFrame, stations: DataFrame, how: str = "inner", prepared: bool = False) -> DataFrame:
    """Trips with origin and destination zone.

    ``how='inner'`` keeps trips whose both ends match a station, as the studies
    do; ``how='left'`` keeps every trip with NULL for unmatched ends.
    ``prepared=True`` means ``stations`` already is a (size-checked) station map.
    """
    smap = stations if prepared else bounded_broadcast(station_map(stations))
    origin = smap.select(F.col("station").alias("unplug_station"), F.col("zone").alias("origin_zone"))
    dest = smap.select(F.col("station").alias("plug_station"), F.col("zone").alias("dest_zone"))
    return trips.join(origin, "unplug_station", how).join(dest, "plug_station", how)


def locate(df: DataFrame, centroids: DataFrame, zone_col: str = "zone", prefix: str = "") -> DataFrame:
    """Left-join zone coordinates onto a (small, aggregated) result.

    ``centroids`` should come from ``TripData.centroids()``, which carries the
    size-checked broadcast hint.
    """
    geo = centroids.select(
        F.col("zone").alias(zone_col),
        F.col("lat").alias(f"{prefix}lat"),
        F.col("lon").alias(f"{prefix}lon"),
    )
    return df.join(geo, zone_col, "left")


def lost_rows(
    trips: DataFrame, stations: DataFrame, prepared: bool = False, preaggregate: bool = False
) -> DataFrame:
    """Trips kept / lost on the way into the studies, by reason (C11, L19): ``(reason, n_trips)``.

    The reasons add up to the input: a trip without a valid date, or with a start or
    end station that is unknown or has no zone.  ``preaggregate`` counts trips per
    (start, end) station pair before the lookups, so the joins move pairs, not trips.
    """
    undated = F.col("trip_date").isNull().alias("undated")
    if preaggregate:
        trips = trips.groupBy("unplug_station", "plug_station", undated).agg(F.count(F.lit(1)).alias("w"))
    else:
        trips = trips.select("unplug_station", "plug_station", undated)
    z = zone_trips(trips, stations, how="left", prepared=prepared)
    o, d = F.col("origin_zone").isNull(), F.col("dest_zone").isNull()
    reason = (
        F.when(F.col("undated"), "no_date")
        .when(o & d, "no_origin_no_destination")
        .when(o, "no_origin")
        .when(d, "no_destination")
        .otherwise("kept")
    )
    return z.groupBy(reason.alias("reason")).agg(trip_count(z).alias("n_trips"))


def zone_pair_counts(zoned: DataFrame) -> DataFrame:
    """Trips per (origin zone, destination zone)."""
    return zoned.groupBy("origin_zone", "dest_zone").agg(trip_count(zoned).alias("n_trips"))


def station_pair_weighted_counts(
    zoned: DataFrame, stations: DataFrame, centroids: DataFrame | None = None
) -> DataFrame:
    """Zone-pair counts plus the number the as-coded per-station-row join would give.

    Joining coordinates per station row repeats each trip ``n(origin) * n(dest)``
    times; that number is computed here algebraically from the aggregated
    counts, never by materialising the fan-out.
    """
    if centroids is None:
        centroids = bounded_broadcast(zone_centroids(stations))
    n = centroids.select("zone", "n_stations")
    counts = zone_pair_counts(zoned)
    return (
        counts.join(n.select(F.col("zone").alias("origin_zone"), F.col("n_stations").alias("n_o")), "origin_zone")
        .join(n.select(F.col("zone").alias("dest_zone"), F.col("n_stations").alias("n_d")), "dest_zone")
        .select(
            "origin_zone",
            "dest_zone",
            "n_trips",
            (F.col("n_trips") * F.col("n_o") * F.col("n_d")).alias("n_rows_as_coded"),
        )
    )
