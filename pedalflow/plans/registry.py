"""Query catalogue: every study as ``(spark, sf_dir) -> DataFrame`` over the driver tables,
plus an independent SQL formulation of the same question for DuckDB.

Registered results are made comparable across engines: doubles are rounded
to 6 places and dates rendered as ``yyyy-MM-dd`` text, on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import day_text, hour_of_text, iso_weekday, time_text, weekday_name, year_of_week
from ..operators.zoning import lost_rows, station_pair_weighted_counts, zone_pair_counts
from ..sources.proxy import event_hours, part_points, with_holes
from ..sources.sinks import write_table
from . import calendar_studies as cal
from . import clusters, flows, riders, zone_stats
from .data import TripData
from .exports import (
    _export, csv_load, json_load, kml_load, load_counts, quarantine_load, rescued_track, schema_drift_export, xml_load,
)
from .monthly import TripStore

Query = Callable[[SparkSession, str], DataFrame]


def finish(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places and render dates as text (comparison form)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _data(spark: SparkSession, sf_dir: str, weighting: str = "trips") -> TripData:
    """The data set of a folder; every query measures and reads the tables as they are now."""
    return TripData.from_proxy(spark, sf_dir, weighting=weighting)


def _holed(spark: SparkSession, sf_dir: str) -> TripData:
    """The same with some dates and some zones unknown."""
    d = _data(spark, sf_dir)
    return TripData(*with_holes(d.trips, d.stations))


def _q(fn, weighting: str = "trips") -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(fn(_data(spark, sf_dir, weighting)))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _dated_trips(d: TripData) -> DataFrame:
    return d.dated(extended=True).select(
        "trip_id", "age_range", "unplug_station", "plug_station", "trip_date",
        "dayofweek", "dayofyear", "dayofmonth", "month", "weekofyear", "year",
        weekday_name(F.col("dayofweek")).alias("weekday_name"),
        iso_weekday(F.col("trip_date")).alias("iso_weekday"),
        year_of_week(F.col("trip_date")).alias("week_year"),
    )


def _lost_rows_exact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips lost when the station list (written with suffixed keys) is matched on the
    whole key, as coded (S1 ``match='exact'``)."""
    from ..sources.proxy import proxy_trips
    from ..sources.stations import read_stations_csv, station_rows
    from .exports import write_station_csv

    path = write_station_csv(spark, sf_dir)
    stations = station_rows(read_stations_csv(spark, path), match="exact")
    return lost_rows(proxy_trips(spark, sf_dir), stations, preaggregate=True)


def _zone_trips_normalised_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per zone pair when the suffixed station list is matched by its leading number
    (S1 ``match='normalised'``, C10)."""
    stations = csv_load(spark, sf_dir)
    return zone_pair_counts(TripData(_data(spark, sf_dir).trips, stations).zoned())


def _result_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone balance written as a result table, one folder per year, and read back."""
    path = _export(spark, sf_dir, "zone-balance")
    write_table(flows.zone_balance(_data(spark, sf_dir)), path, partition_by=["year"])
    return spark.read.parquet(path)


def _union_by_name(d: TripData) -> DataFrame:
    """Two slices of which only the later one has ``track``: matched by name, NULL where missing.
    Trips without a date are part of the earlier slice."""
    from ..sources.trips import union_by_name

    t = d.trips.select("trip_id", "age_range", "trip_date")
    late = F.coalesce(F.year("trip_date") >= 1998, F.lit(False))
    with_track = t.filter(late).select("trip_date", (F.col("trip_id") * 2).alias("track"), "age_range", "trip_id")
    return union_by_name([t.filter(~late), with_track])


def _hour_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = event_hours(spark, sf_dir)
    t = F.col("ts_text")
    return ev.select("event_id", day_text(t).alias("day_text"), time_text(t).alias("time_text"),
                     hour_of_text(t).alias("hour"))


def _year_text(d: TripData) -> DataFrame:
    text = F.date_format("trip_date", "yyyy-MM-dd")
    return d.trips.groupBy(F.substring(text, 1, 4).alias("year_text")).agg(F.count(F.lit(1)).alias("n_trips"))


def _union_dedupe(d: TripData) -> DataFrame:
    """Two overlapping slices whose columns drift (the later one carries ``track``),
    reconciled by name, drift column dropped, duplicates removed (G1, G2, D16, S12).
    Trips without a date are part of the earlier slice."""
    from ..sources.trips import union_dedupe

    cols = ["trip_id", "user_type", "age_range", "travel_time", "unplug_station", "plug_station", "trip_date"]
    t = d.trips.select(*cols)
    early = t.filter((F.year("trip_date") <= 1998) | F.col("trip_date").isNull())
    late = t.filter(F.year("trip_date") >= 1998).withColumn("track", F.struct(F.col("trip_id").alias("id")))
    return union_dedupe([early, late]).drop("track").distinct()


def _zone_balance_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips in three loads, the latest years first and each of the others with copies of
    records that stand in other loads; the balance from the cube that the loads have kept."""
    d = _data(spark, sf_dir)
    store = TripStore(spark, _export(spark, sf_dir, "trip-store"), d.stations)
    store.clear()
    year, again = F.year("trip_date"), F.col("trip_id") % 5 == 0
    store.load_trips(d.trips.filter(year >= 1999), "late")
    store.load_trips(d.trips.filter((year < 1997) | again), "early")
    store.load_trips(d.trips.filter((year >= 1997) & (year < 1999) | again), "middle")
    return flows.zone_balance(store.data())


def _station_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.station_clusters(part_points(spark, sf_dir), k=4, seed=1, unit=100, steps=10)


def _silhouette_by_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(clusters.silhouette_by_k(part_points(spark, sf_dir), ks=range(2, 10), seed=1, unit=100, steps=10))


def _cluster_od_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _data(spark, sf_dir)
    groups = clusters.station_clusters(clusters.station_points(d), k=4, seed=1, unit=100, steps=10)
    return clusters.cluster_od_counts(d, groups)


def _random_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.random_zone(_data(spark, sf_dir), seed=7)


def queries() -> dict[str, Query]:
    return {
        "dated_trips": _q(_dated_trips),
        "zoned_trips_counts": _q(lambda d: zone_pair_counts(d.zoned())),
        "located_zones": _q(lambda d: d.centroids()),
        "station_pair_weighted_counts": _q(
            lambda d: station_pair_weighted_counts(d.zoned(), d.stations, centroids=d.centroids())
        ),
        "years": _q(cal.years),
        "distinct_zone_count": _q(cal.distinct_zone_count),
        "trips_by_weekday_year_total": _q(lambda d: cal.trips_by_weekday_year(d)),
        "trips_by_weekday_year_zone": _q(lambda d: cal.trips_by_weekday_year(d, by_zone=True)),
        "trips_by_weekday_year_outer": _q(lambda d: cal.trips_by_weekday_year(d, how="outer")),
        "trips_by_week_year": _q(cal.trips_by_week_year),
        "zone_stats": _q(lambda d: zone_stats.zone_stats(d, "all")),
        "zone_stats_weekend": _q(lambda d: zone_stats.zone_stats(d, "weekend")),
        "zone_stats_weekend_as_coded": _q(lambda d: zone_stats.zone_stats(d, "weekend", weekend_rule="as_coded")),
        "zone_stats_season": _q(lambda d: zone_stats.zone_stats(d, "season")),
        "zone_extremes": _q(lambda d: zone_stats.zone_extremes(d, "all")),
        "zone_extremes_weekend": _q(lambda d: zone_stats.zone_extremes(d, "weekend")),
        "zone_extremes_season": _q(lambda d: zone_stats.zone_extremes(d, "season")),
        "zone_balance": _q(lambda d: flows.zone_balance(d)),
        # As coded (S2): counts over the per-station-row coordinate join, computed by weights.
        "trips_by_weekday_year_as_coded": _q(lambda d: cal.trips_by_weekday_year(d), "station_pairs"),
        "trips_by_week_year_as_coded": _q(cal.trips_by_week_year, "station_pairs"),
        "zone_stats_as_coded": _q(lambda d: zone_stats.zone_stats(d, "all"), "station_pairs"),
        "zone_balance_as_coded": _q(lambda d: flows.zone_balance(d), "station_pairs"),
        "zone_stats_season_as_coded": _q(lambda d: zone_stats.zone_stats(d, "season"), "station_pairs"),
        "zone_stats_weekend_all_as_coded": _q(
            lambda d: zone_stats.zone_stats(d, "weekend", weekend_rule="as_coded"), "station_pairs"
        ),
        # The batch job's path: one cube built from the whole tables, the study read from it.
        "zone_stats_season_from_cube": _q(lambda d: zone_stats.zone_stats(d.with_zone_cube(), "season")),
        "zone_balance_from_cube": _q(lambda d: flows.zone_balance(d.with_zone_cube())),
        # Months loaded one after the other, each counted into the cube.
        "zone_balance_incremental": lambda spark, sf_dir: finish(_zone_balance_incremental(spark, sf_dir)),
        "zone_balance_full": _q(lambda d: flows.zone_balance(d, how="full_outer")),
        "zone_balance_scaled": _q(lambda d: flows.zone_balance_scaled(d)),
        "zone_balance_share": _q(lambda d: flows.zone_balance_share(d)),
        "zone_in_out_demand": _q(flows.zone_in_out_demand),
        "growth_by_year": _q(cal.growth_by_year),
        "daily_peak": _q(cal.daily_peak),
        "daily_peak_by_zone": _q(cal.daily_peak_by_zone),
        "station_balance": _q(flows.station_balance),
        "station_balance_top10": _q(lambda d: flows.station_balance_top(d, 10)),
        "usage_by_age": _q(lambda d: riders.usage_by_age(d)),
        "known_age_usage": _q(lambda d: riders.usage_by_age(d, known_only=True)),
        "count_by_user_type": _q(lambda d: riders.count_by(d, "user_type")),
        "count_by_age": _q(lambda d: riders.count_by(d, "age_range")),
        "count_by_base": _q(lambda d: riders.count_by(d, "plug_base")),
        "od_weekday_counts": _q(flows.od_weekday_counts),
        "od_weekday_top": _q(lambda d: flows.od_weekday_top(d, 10)),
        "od_selected_stations": _q(lambda d: flows.od_selected_stations(d, n=5)),
        "travel_time_totals": _q(riders.travel_time_totals),
        "above_average_by_age": _q(riders.above_average_by_age),
        "above_average_share": _q(riders.above_average_share),
        "travel_time_by_age_summary": _q(riders.travel_time_by_age_summary),
        # One histogram of the trips, the rider studies read from it.
        "usage_by_age_from_cube": _q(lambda d: riders.usage_by_age(d.with_rider_cube())),
        "above_average_share_from_cube": _q(lambda d: riders.above_average_share(d.with_rider_cube())),
        "travel_time_by_age_summary_from_cube": _q(lambda d: riders.travel_time_by_age_summary(d.with_rider_cube())),
        "lost_rows": _q(
            lambda d: lost_rows(d.trips, d.station_lookup(), prepared=True, preaggregate=not d.dims_bounded())
        ),
        # What the studies do with unknown dates and zones.
        "lost_rows_null_zone": lambda spark, sf_dir: finish(
            lost_rows(*(lambda d: (d.trips, d.stations))(_holed(spark, sf_dir)), preaggregate=True)
        ),
        "undated_trips": lambda spark, sf_dir: finish(
            _holed(spark, sf_dir).undated().select("trip_id", "age_range", "unplug_station", "plug_station", "reason")
        ),
        "zone_balance_null_zone": lambda spark, sf_dir: finish(flows.zone_balance(_holed(spark, sf_dir))),
        "zone_stats_null_zone_from_cube": lambda spark, sf_dir: finish(
            zone_stats.zone_stats(_holed(spark, sf_dir).with_zone_cube(), "all")
        ),
        # Parameters.
        "trips_by_weekday_one_zone": _q(lambda d: cal.trips_by_weekday_year(d, zone="NO WINTER", years=[1996, 1998])),
        "trips_by_weekday_random_zone": _q(lambda d: cal.trips_by_weekday_year(d, zone="random", seed=7, how="outer")),
        "zone_stats_two_years": _q(lambda d: zone_stats.zone_stats(d, "all", years=[1997, 1999])),
        "zone_balance_one_year": _q(lambda d: flows.zone_balance(d, years=[2000])),
        "od_listed_stations": _q(lambda d: flows.od_selected_stations(d, stations=[1, 2, 3, 6, 8])),
        "zone_trips_normalised_keys": lambda spark, sf_dir: finish(_zone_trips_normalised_keys(spark, sf_dir)),
        "union_by_name": _q(_union_by_name),
        "result_sink": lambda spark, sf_dir: finish(_result_sink(spark, sf_dir)),
        "standardised_points": lambda spark, sf_dir: finish(clusters.standardised_points(part_points(spark, sf_dir))),
        "silhouette_of_brands": lambda spark, sf_dir: finish(
            clusters.silhouette_of(part_points(spark, sf_dir), "brand")
        ),
        "lost_rows_exact_keys": lambda spark, sf_dir: finish(_lost_rows_exact_keys(spark, sf_dir)),
        "union_dedupe": _q(_union_dedupe),
        "hour_text": lambda spark, sf_dir: finish(_hour_text(spark, sf_dir)),
        "year_text": _q(_year_text),
        "json_load": lambda spark, sf_dir: finish(json_load(spark, sf_dir)),
        "quarantine_load": lambda spark, sf_dir: finish(quarantine_load(spark, sf_dir)),
        "rescued_track": lambda spark, sf_dir: finish(rescued_track(spark, sf_dir)),
        "load_counts": lambda spark, sf_dir: finish(load_counts(spark, sf_dir)),
        "csv_load": lambda spark, sf_dir: finish(csv_load(spark, sf_dir)),
        "xml_load": lambda spark, sf_dir: finish(xml_load(spark, sf_dir)),
        "kml_load": lambda spark, sf_dir: finish(kml_load(spark, sf_dir)),
        "schema_drift": lambda spark, sf_dir: finish(schema_drift_export(spark, sf_dir)),
        "station_clusters": _station_clusters,
        "silhouette_by_k": _silhouette_by_k,
        "cluster_od_counts": _cluster_od_counts,
        "random_zone": _random_zone,
    }
