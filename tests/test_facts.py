"""Counts recorded for the proxy view in FIXTURES.md section 4."""

import os

import pytest
from pyspark.sql import functions as F

from pedalflow.operators import station_pair_weighted_counts
from pedalflow.plans.data import TripData

FACTS = {
    # sf: (trips, stations, zones, kept after both zone joins, rows of the as-coded fan-out)
    "0.001": (6000, 10, 10, 5462, 5462),
    "0.01": (60000, 100, 28, 54652, 1434966),
}


@pytest.mark.parametrize("sf", sorted(FACTS))
def test_proxy_facts(spark, sf):
    path = f"/root/testdata/sf{sf}"
    if not os.path.isdir(path):
        pytest.skip("driver tables not present")
    d = TripData.from_proxy(spark, path)
    z = d.zoned()
    pairs = station_pair_weighted_counts(z, d.stations, centroids=d.centroids())
    kept, fan = pairs.agg(F.sum("n_trips"), F.sum("n_rows_as_coded")).first()
    got = (d.trips.count(), d.stations.count(), d.centroids().count(), z.count(), fan)
    assert got == FACTS[sf]
    assert kept == FACTS[sf][3]
    # 2001 stops on 4 November: weeks 45-53 drop out of the inner week x year table
    from pedalflow.plans.calendar_studies import trips_by_week_year

    assert trips_by_week_year(TripData(d.trips, d.stations, max_broadcast_rows=10**6)).count() == 44
