"""Random small trip sets against a plain-Python brute force."""

import datetime as dt
import math
import statistics
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pedalflow.plans import flows, zone_stats
from pedalflow.plans.data import TripData

STATIONS = {1: "A", 2: "A", 3: "B", 4: "C"}  # station 9 is unknown
trip = st.tuples(
    st.dates(min_value=dt.date(2016, 12, 25), max_value=dt.date(2018, 1, 10)),
    st.sampled_from([1, 2, 3, 4, 9]),
    st.sampled_from([1, 2, 3, 4, 9]),
)


def _data(spark, trips):
    t = spark.createDataFrame(
        [(i, d, o, p) for i, (d, o, p) in enumerate(trips)],
        "trip_id long, trip_date date, unplug_station long, plug_station long",
    )
    s = spark.createDataFrame(
        [(str(k), k, z, None, 1.0, 2.0, None) for k, z in STATIONS.items()],
        "station_key string, station long, zone string, district string, lat double, lon double, docks int",
    )
    return TripData(t, s)


def _kept(trips):
    return [(d, STATIONS[o], STATIONS[p]) for d, o, p in trips if o in STATIONS and p in STATIONS]


def _dow(d):  # Spark numbering, 1 = Sunday
    return d.isoweekday() % 7 + 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40))
def test_zone_stats_match_brute_force(spark, trips):
    counts = Counter((d.year, zo, _dow(d)) for d, zo, _ in _kept(trips))
    per = defaultdict(list)
    for (y, z, _), n in counts.items():
        per[(y, z)].append(n)
    got = {(r["year"], r["zone"]): r for r in zone_stats.zone_stats(_data(spark, trips), "all").collect()}
    assert set(got) == set(per)
    for key, ns in per.items():
        r = got[key]
        assert math.isclose(r["mean_trips"], statistics.mean(ns))
        assert (r["min_trips"], r["max_trips"], r["n_units"]) == (min(ns), max(ns), len(ns))
        if len(ns) == 1:
            assert r["std_trips"] is None
        else:
            assert math.isclose(r["std_trips"], statistics.stdev(ns))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40))
def test_full_balance_matches_brute_force(spark, trips):
    out = Counter((d.year, zo) for d, zo, _ in _kept(trips))
    inn = Counter((d.year, zd) for d, _, zd in _kept(trips))
    want = {k: (out.get(k, 0), inn.get(k, 0)) for k in set(out) | set(inn)}
    got = {(r["year"], r["zone"]): (r["n_out"], r["n_in"])
           for r in flows.zone_balance(_data(spark, trips), "full_outer").collect()}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40))
def test_weekday_year_table_matches_brute_force(spark, trips):
    from pedalflow.plans import calendar_studies as cal

    counts = Counter((_dow(d), d.year) for d, _, _ in _kept(trips))
    years = [2016, 2017, 2018]
    want = {dw: tuple(counts.get((dw, y)) for y in years) for dw in {k[0] for k in counts}}
    got = {r["dayofweek"]: tuple(r[str(y)] for y in years)
           for r in cal.trips_by_weekday_year(_data(spark, trips), years=years, how="outer").collect()}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40))
def test_daily_peak_by_zone_matches_brute_force(spark, trips):
    from pedalflow.plans import calendar_studies as cal

    per = Counter((STATIONS[o], d) for d, o, _ in trips if o in STATIONS)  # origin known is enough
    want = {}
    for (z, d), n in per.items():
        best = want.get(z)
        if best is None or n > best[0] or (n == best[0] and d < best[1]):
            want[z] = (n, d)
    got = {r["zone"]: (r["max_daily_trips"], r["peak_date"]) for r in cal.daily_peak_by_zone(_data(spark, trips)).collect()}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40))
def test_in_out_demand_matches_brute_force(spark, trips):
    arr = Counter(STATIONS[p] for _, _, p in trips if p in STATIONS)
    dep = Counter(STATIONS[o] for _, o, _ in trips if o in STATIONS)
    want = {z: (n, dep.get(z)) for z, n in arr.items()}  # zones with arrivals; no departures -> NULL
    got = {r["zone"]: (r["arrivals"], r["departures"]) for r in flows.zone_in_out_demand(_data(spark, trips)).collect()}
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40))
def test_station_balance_matches_brute_force(spark, trips):
    out = Counter(o for _, o, _ in trips)
    inn = Counter(p for _, _, p in trips)
    want = {s: (out[s], inn[s], out[s] - inn[s]) for s in set(out) & set(inn)}
    got = {r["station"]: (r["n_unplugs"], r["n_plugs"], r["difference"])
           for r in flows.station_balance(_data(spark, trips)).collect()}
    assert got == want


def _bucket(study, d):
    if study == "weekend":
        return "weekend" if _dow(d) in (6, 7, 1) else "weekday"
    m = d.month
    return "spring" if 3 <= m <= 6 else "summer" if 7 <= m <= 9 else "autumn" if m >= 10 else "winter"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=1, max_size=40), st.sampled_from(["weekend", "season"]))
def test_bucketed_zone_stats_match_brute_force(spark, trips, study):
    unit = (lambda d: _dow(d)) if study == "weekend" else (lambda d: d.month)
    counts = Counter((d.year, _bucket(study, d), zo, unit(d)) for d, zo, _ in _kept(trips))
    per = defaultdict(list)
    for (y, b, z, _), n in counts.items():
        per[(y, b, z)].append(n)
    got = {(r["year"], r["bucket"], r["zone"]): r for r in zone_stats.zone_stats(_data(spark, trips), study).collect()}
    assert set(got) == set(per)
    for key, ns in per.items():
        r = got[key]
        assert math.isclose(r["mean_trips"], statistics.mean(ns))
        assert (r["min_trips"], r["max_trips"], r["n_units"]) == (min(ns), max(ns), len(ns))
