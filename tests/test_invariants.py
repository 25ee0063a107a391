"""Invariants that must hold whatever the data."""

from pyspark.sql import functions as F

from pedalflow.operators import lost_rows
from pedalflow.plans import flows, zone_stats


def _sum(df, c):
    return df.agg(F.sum(c)).first()[0]


def test_departures_equal_arrivals_equal_matched(data):
    b = flows.zone_balance(data, "full_outer")
    matched = data.zoned().count()
    assert _sum(b, "n_out") == _sum(b, "n_in") == matched


def test_buckets_partition_all_units(data):
    all_ = zone_stats.zone_stats(data, "all")
    wk = zone_stats.zone_stats(data, "weekend")
    total = _sum(all_, F.col("mean_trips") * F.col("n_units"))
    split = _sum(wk, F.col("mean_trips") * F.col("n_units"))
    assert round(total) == round(split) == data.zoned().count()
    season = zone_stats.zone_stats(data, "season")
    assert round(_sum(season, F.col("mean_trips") * F.col("n_units"))) == data.zoned().count()


def test_lost_plus_kept_is_input(data):
    assert _sum(lost_rows(data.trips, data.stations), "n_trips") == data.trips.count()


def test_station_balance_sums(data):
    sb = flows.station_balance(data)
    assert _sum(sb, "n_unplugs") - _sum(sb, "n_plugs") == _sum(sb, "difference")


def test_lost_rows_preaggregated_same(data):
    from conftest import rows

    assert rows(lost_rows(data.trips, data.stations, preaggregate=True)) == rows(lost_rows(data.trips, data.stations))
