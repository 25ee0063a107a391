"""A store fed month by month holds what one load of all files holds."""

import itertools
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import STATION_CSV, TRIP_FILES
from pedalflow.plans import calendar_studies as cal
from pedalflow.plans import flows, monthly, zone_stats
from pedalflow.plans.data import TripData
from pedalflow.plans.registry import finish
from pedalflow.sources.stations import read_stations_csv, station_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stations(spark):
    return station_rows(read_stations_csv(spark, STATION_CSV))


def same(one, other):
    for study in (flows.zone_balance, lambda d: zone_stats.zone_stats(d, "season"), lambda d: cal.trips_by_weekday_year(d, how="outer"), cal.daily_peak_by_zone):
        assert sorted(finish(study(one)).collect(), key=repr) == sorted(finish(study(other)).collect(), key=repr)
    cols = [c for c in one.trips.columns if c in other.trips.columns]
    assert sorted(map(tuple, one.trips.select(*cols).collect()), key=repr) == sorted(map(tuple, other.trips.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("order", list(itertools.permutations(range(2))))
def test_files_in_any_order_give_the_batch(spark, stations, data, tmp_path, order):
    store = monthly.TripStore(spark, str(tmp_path), stations)
    counts = [store.load_files(TRIP_FILES[i], f"file{i}") for i in order]
    batch = TripData(data.trips.filter("trip_date IS NOT NULL"), data.stations)
    same(store.data(), batch)
    assert sum(c.n_copies for c in counts) >= 1 and sum(c.n_malformed for c in counts) >= 1
    for c in counts:
        assert c.n_lines == c.n_new + c.n_copies + c.n_malformed + c.n_no_date
    assert sum(c.n_new for c in counts) == batch.trips.count()
    aside = spark.read.json(os.path.join(str(tmp_path), "quarantine"))
    assert aside.count() == sum(c.n_malformed + c.n_no_date for c in counts)


def lines(path, trips):
    with open(path, "w", encoding="utf-8") as f:
        for oid, day, u, p in trips:
            f.write(json.dumps({"_id": {"$oid": oid}, "idunplug_station": u, "idplug_station": p, "travel_time": 60, "ageRange": 1,
                                "user_type": 1, "unplug_hourTime": {"$date": f"{day}T08:00:00.000+0200"}}) + "\n")
    return str(path)


def test_a_load_run_again_replaces_what_it_brought(spark, stations, tmp_path):
    store = monthly.TripStore(spark, str(tmp_path / "store"), stations)
    one = [("a", "2017-04-03", 1, 2), ("b", "2017-04-30", 2, 1), ("c", "2017-05-01", 1, 1), ("c", "2017-05-01", 1, 1)]
    two = [("b", "2017-04-30", 2, 1), ("d", "2017-05-02", 2, 2)]
    assert store.load_files(lines(tmp_path / "1.json", one), "2017").n_new == 3
    got = store.load_files(lines(tmp_path / "2.json", two), "may")
    assert (got.n_new, got.n_copies, got.months) == (1, 1, ("2017-04", "2017-05"))
    ids = lambda: sorted(r["trip_id"] for r in store.data().trips.collect())
    days = lambda: {str(r["trip_date"]): r["n"] for r in store.data().cube.groupBy("trip_date").agg(F.sum("n_out_any").alias("n")).collect()}
    before = days()
    assert store.load_files(lines(tmp_path / "1.json", one), "2017").n_new == 3 and ids() == ["a", "b", "c", "d"] and days() == before
    # a corrected file: April is empty now but for a trip that "may" has as well
    assert store.load_files(lines(tmp_path / "1.json", [("e", "2017-06-01", 1, 2)]), "2017").n_new == 1
    assert ids() == ["d", "e"] and set(days()) == {"2017-05-02", "2017-06-01"}
    empty = store.load_files(lines(tmp_path / "0.json", []), "none")
    assert empty == monthly.LoadCounts(0, 0, 0, 0, 0, ()) and ids() == ["d", "e"]


def test_a_load_reads_and_writes_only_the_months_it_touches(spark, stations, tmp_path):
    store = monthly.TripStore(spark, str(tmp_path / "store"), stations)
    store.load_files(lines(tmp_path / "1.json", [(f"a{i}", f"2017-0{m}-05", 1, 2) for m in range(1, 10) for i in range(20)]), "first")
    files = lambda part: {os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "store" / part) for f in fs if f.endswith(".parquet")}
    trips, cube = files("trips"), files("cube")
    new = spark.read.parquet(store.trips_dir).filter("ym = '2017-03'").select("ym", "digest")
    plan = store._new(new, {"2017-03"}, "x")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and plan.count("2017-03") >= 2
    assert store._new(new, {"2017-03"}, "x").count() == 0
    store.load_files(lines(tmp_path / "2.json", [("b", "2017-03-06", 1, 2)]), "second")
    assert trips < files("trips") and len(files("trips") - trips) == 1
    assert {f for f in cube - files("cube")} == {f for f in cube if "ym=2017-03" in f}


def test_records_differ_by_the_field_a_value_stands_in(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL), (NULL, 1), (1, 1) AS t (a, b)")
    assert df.select(monthly.record_digest(["a", "b"]).alias("d")).distinct().count() == 3


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_another_station_list_rebuilds_the_cube(spark, tmp_path):
    d = TripData.from_proxy(spark, SF_DIR)
    store = monthly.TripStore(spark, str(tmp_path), d.stations)
    store.load_trips(d.trips, "all")
    fewer = TripData(d.trips, d.stations.filter("station % 2 = 0"))
    again = monthly.TripStore(spark, str(tmp_path), fewer.stations)
    again.rebuild_cube()
    same(again.data(), fewer)
