"""Zone studies served from the daily zone cube equal the trip-level answers."""

import os

import pytest

from pedalflow.plans import calendar_studies as cal
from pedalflow.plans import flows, riders, zone_stats
from pedalflow.plans.data import TripData
from pedalflow.plans.registry import finish

STUDIES = {
    "weekday_year": lambda d: cal.trips_by_weekday_year(d, by_zone=True),
    "weekday_year_outer": lambda d: cal.trips_by_weekday_year(d, how="outer"),
    "week_year": cal.trips_by_week_year,
    "week_year_iso": lambda d: cal.trips_by_week_year(d, year_basis="iso", how="outer"),
    "stats": lambda d: zone_stats.zone_stats(d, "all"),
    "stats_weekend": lambda d: zone_stats.zone_stats(d, "weekend"),
    "stats_season": lambda d: zone_stats.zone_stats(d, "season"),
    "extremes": lambda d: zone_stats.zone_extremes(d, "all"),
    "balance": flows.zone_balance,
    "balance_full": lambda d: flows.zone_balance(d, "full_outer"),
    "peak": cal.daily_peak,
    "peak_by_zone": cal.daily_peak_by_zone,
    "years": cal.years,
    "distinct": cal.distinct_zone_count,
}


def _same(a, b):
    for name, fn in STUDIES.items():
        assert sorted(finish(fn(a)).collect()) == sorted(finish(fn(b)).collect()), name


def test_cube_on_fixture(data):
    cubed = data.with_zone_cube()
    assert cubed.cube is not None and cubed.zoned().columns == data.zoned().columns
    days, zones = data.dated().select("trip_date").distinct().count(), data.centroids().count()
    assert cubed.cube.count() <= days * zones  # linear in the zones
    _same(cubed, data)


def test_cube_on_driver_tables_with_both_weightings(spark):
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver tables not present")
    for weighting in ("trips", "station_pairs"):
        d = TripData.from_proxy(spark, path, weighting=weighting)
        _same(d.with_zone_cube(), d)


def test_materialise_keeps_options(data, tmp_path):
    d = TripData(data.trips, data.stations, weighting="station_pairs", max_broadcast_rows=5)
    m = d.materialise(str(tmp_path / "t"))
    assert (m.weighting, m.max_broadcast_rows, m.cube) == ("station_pairs", 5, None)
    assert sorted(finish(flows.zone_balance(m)).collect()) == sorted(finish(flows.zone_balance(d)).collect())


def _holes(spark):
    """Five stations, one without a zone, and a trip without a date."""
    from pyspark.sql import functions as F

    zones = [(1, "A"), (2, "A"), (3, "B"), (4, None), (5, "C")]
    stations = spark.createDataFrame(
        [(str(n), n, z, "d", float(n), 1.0, 3) for n, z in zones],
        "station_key string, station long, zone string, district string, lat double, lon double, docks int",
    )
    ends = [(1, 3, "2017-01-02"), (2, 4, "2017-01-02"), (4, 1, "2017-01-02"), (3, 5, None), (5, 9, "2017-01-03"), (4, 9, "2017-01-03"), (3, 1, "2017-01-02")]
    trips = spark.createDataFrame(
        [(str(i), 1, 1, 60, u, p, d) for i, (u, p, d) in enumerate(ends)],
        "trip_id string, user_type int, age_range int, travel_time long, unplug_station long, plug_station long, day string",
    ).withColumn("trip_date", F.to_date("day")).drop("day")
    return TripData(trips, stations)


def test_unknown_zones_and_dates_are_lost_on_every_path(spark):
    from pedalflow.operators import lost_rows

    d = _holes(spark)
    _same(d.with_zone_cube(), d)
    assert sorted(map(tuple, d.zoned().select("unplug_station", "plug_station").collect())) == [(1, 3), (3, 1)]
    lost = {r["reason"]: r["n_trips"] for r in lost_rows(d.trips, d.stations).collect()}
    assert lost == {"kept": 2, "no_date": 1, "no_origin": 1, "no_destination": 2, "no_origin_no_destination": 1}
    assert sum(lost.values()) == d.trips.count() and d.undated().count() == 1
    assert {r["zone"] for r in flows.zone_balance(d, "full_outer").collect()} == {"A", "B"}
    assert None not in {r["year"] for r in zone_stats.zone_stats(d, "all").collect()}


RIDER_STUDIES = {
    "usage": riders.usage_by_age,
    "usage_known": lambda d: riders.usage_by_age(d, known_only=True),
    "totals": riders.travel_time_totals,
    "above": riders.above_average_share,
    "above_by_age": riders.above_average_by_age,
    "summary": riders.travel_time_by_age_summary,
    "user_type": lambda d: riders.count_by(d, "user_type"),
    "base": lambda d: riders.count_by(d, "plug_base"),
}


def test_rider_studies_read_the_histogram(spark, data):
    sources = [data]
    if os.path.isdir("/root/testdata/sf0.001"):
        sources.append(TripData.from_proxy(spark, "/root/testdata/sf0.001"))
    for d in sources:
        cubed = d.with_rider_cube()
        for name, fn in RIDER_STUDIES.items():
            assert sorted(finish(fn(cubed)).collect()) == sorted(finish(fn(d)).collect()), name
        plan = riders.above_average_share(cubed)._jdf.queryExecution().executedPlan().toString()
        assert "Scan ExistingRDD" in plan and "Scan parquet" not in plan and "Scan text" not in plan
    empty = TripData(data.trips.limit(0), data.stations)
    assert riders.travel_time_totals(empty.with_rider_cube()).collect() == riders.travel_time_totals(empty).collect()
    assert riders.travel_time_totals(empty).first()["n_trips"] == 0
