import datetime as dt

from conftest import FIXTURES, STATION_CSV, TRIP_FILES, rows

from pedalflow.operators import lost_rows
from pedalflow.plans.data import TripData
from pedalflow.sources.drift import drift_of_lines, paths_of
from pedalflow.sources import (
    load_trips,
    quarantine,
    read_station_points_kml,
    read_station_points_xml,
    read_stations_csv,
    read_trips_json,
    schema_drift,
    station_rows,
)


def test_json_load_quarantines_corrupt_line(spark):
    raw = read_trips_json(spark, TRIP_FILES)
    bad = quarantine(raw).collect()
    assert len(bad) == 1
    assert '"bad"' in bad[0]["_corrupt_record"]
    assert bad[0]["source_file"].endswith("trips_2018.json")


def test_json_load_set_union_and_drift(spark):
    # 10 + 9 good lines, one exact duplicate across the files; `track` only in 2018.
    trips = load_trips(spark, TRIP_FILES)
    assert trips.count() == 18
    assert load_trips(spark, TRIP_FILES, dedupe=False).count() == 19
    assert "track" not in trips.columns


def test_date_is_taken_from_text_not_instant(spark):
    # 2017-06-01T00:30+0200 is 2017-05-31 22:30 UTC; the trip belongs to 1 June.
    t = load_trips(spark, TRIP_FILES).filter("trip_id = 't04'").collect()[0]
    assert t["trip_date"] == dt.date(2017, 6, 1)
    assert t["trip_hour"] == 0


def test_schema_drift_report(spark):
    rep = schema_drift(spark, TRIP_FILES)
    track = rows(rep.filter("column = 'track'"), "n_lines", "in_every_file")
    assert track == [(8, False)]
    corrupt = rep.filter("column = '_corrupt_record'").collect()
    assert len(corrupt) == 1 and corrupt[0]["n_lines"] == 1
    oid = rows(rep.filter("column = '_id'"), "n_lines", "in_every_file")
    assert oid == [(9, True), (10, True)]


def test_schema_drift_reports_nested_paths(spark):
    lines = ['{"a": {"b": {"c.d": 1}, "e": [{"x": 1.5}, {"x": 2, "y": null}]}, "f": [[true]]}', '{"a": {"b": "text"}}', '{"a": ', "", '{"a": {"b": {"c.d": 7}}}', "5"]
    rep = drift_of_lines(spark.createDataFrame([("one", x) for x in lines] + [("two", '{"a": 1}')], "source_file string, value string"))
    got = {(r["source_file"], r["column"]): (r["types"], r["n_lines"], r["n_file_lines"], r["in_every_file"]) for r in rep.collect()}
    assert got["one", "a.b"] == ("OBJECT<`c.d`: BIGINT> | STRING", 3, 5, False)
    assert got["one", "a.b.`c.d`"] == ("BIGINT", 2, 5, False)
    assert got["one", "a.e[].x"][:2] == ("DECIMAL(21,1)", 1) and got["one", "a.e[].y"][0] == "VOID"
    assert got["one", "f[][]"] == ("BOOLEAN", 1, 5, False)
    assert got["one", "a"][3] and got["two", "a"] == ("BIGINT", 1, 1, True)
    assert got["one", "_corrupt_record"] == ("STRING", 1, 5, False)
    assert drift_of_lines(spark.createDataFrame([], "source_file string, value string")).collect() == []


def test_paths_of_a_shape_with_odd_names():
    assert paths_of("OBJECT<`a``b`: STRING, `x y`: ARRAY<DECIMAL(5,2)>, z: OBJECT<>>") == [
        ("`a`b`", "STRING"), ("x y", "ARRAY<DECIMAL(5,2)>"), ("x y[]", "DECIMAL(5,2)"), ("z", "OBJECT<>")]
    assert paths_of("BIGINT") == [] and paths_of("ARRAY<VOID>") == [("[]", "VOID")]


def test_drift_shuffles_a_row_per_shape_not_per_key(spark):
    lines = spark.range(5000).selectExpr("'f' AS source_file", "concat('{\"a\": ', id, ', \"b\": {\"c\": ', id, '}}') AS value")
    shapes = lines.selectExpr("schema_of_variant(try_parse_json(value)) AS s").distinct().count()
    assert shapes == 1
    assert {(r["column"], r["n_lines"]) for r in drift_of_lines(lines).collect()} == {("a", 5000), ("b", 5000), ("b.c", 5000)}


def test_unknown_fields_are_rescued(spark, tmp_path):
    p = tmp_path / "more.json"
    p.write_text('{"_id": {"$oid": "x1"}, "track": {"from": 3, "to": [1, 2]}, "new": null}\n{"_id": {"$oid": "x2"}}\n{"_id": \n')
    raw = read_trips_json(spark, str(p), rescue=True)
    got = {r["id"]: (r["a"], r["b"], r["c"]) for r in raw.selectExpr(
        "_id.`$oid` AS id", "try_variant_get(rescued, '$.track.to[1]', 'int') AS a", "try_variant_get(rescued, '$._id', 'string') AS b",
        "to_json(rescued) AS c").collect()}
    assert got["x1"][:2] == (2, None) and '"new":null' in got["x1"][2] and got["x2"] == got[None] == (None, None, None)


def test_station_csv_normalised_keys(spark):
    st = station_rows(read_stations_csv(spark, STATION_CSV))
    got = rows(st, "station_key", "station", "zone")
    assert ("001 a", 1, "Palacio") in got and ("001 b", 1, "Palacio") in got
    assert ("020 ampliacion", 20, "Cortes") in got
    assert ("140 ampliación", 140, "Justicia") in got
    assert st.count() == 10
    # no-break space folded and trimmed away
    assert {r["district"] for r in st.collect()} == {"01 Centro", "02 Arganzuela"}
    assert rows(st.filter("station = 2"), "lat", "lon", "docks") == [(40.4168, -3.7035, 24)]


def test_station_csv_exact_mode_loses_suffixed_keys(spark):
    st = station_rows(read_stations_csv(spark, STATION_CSV), match="exact")
    assert st.filter("station IS NULL").count() == 4


def test_station_xml_and_kml(spark):
    xml = read_station_points_xml(spark, f"{FIXTURES}/stations.xml")
    assert rows(xml) == [("Huertas", 40.414, -3.699), ("Opera", 40.418, -3.71), ("Puerta del Sol", 40.4168, -3.7035)]
    kml = read_station_points_kml(spark, f"{FIXTURES}/stations.kml")
    assert rows(kml) == [("Opera", 40.418, -3.71), ("Puerta del Sol", 40.4168, -3.7035)]


def test_literal_station_rows(spark):
    from pedalflow.sources import stations_from_rows

    raw = stations_from_rows(spark, [{"Número": "001 b", "Barrio": "Palacio", "Latitud": "40.4"},
                                     {"Número": "7", "Barrio": "Justicia", "Número de Plazas": "24"}])
    got = rows(station_rows(raw), "station", "zone", "lat", "docks")
    assert got == [(1, "Palacio", 40.4, None), (7, "Justicia", None, 24)]


def test_batch_job_writes_every_study(spark, tmp_path):
    from pedalflow.plans.job import STUDIES, run_studies

    out = str(tmp_path / "out")
    written = run_studies(spark, TRIP_FILES, STATION_CSV, out)
    assert set(written) == set(STUDIES)
    assert spark.read.json(f"{out}/quarantine").count() == 1
    stats = spark.read.parquet(written["zone_stats"])
    assert sorted({r["year"] for r in stats.collect()}) == [2017, 2018]
    assert spark.read.parquet(f"{out}/trips").count() == 18
    # every line is counted once, and the zone lookup's losses are those of lost_rows
    counts = {r["reason"]: r["n_trips"] for r in spark.read.parquet(f"{out}/counts").collect()}
    data = TripData.from_files(spark, TRIP_FILES, STATION_CSV)
    lost = {r["reason"]: r["n_trips"] for r in lost_rows(data.trips, data.stations).collect()}
    assert counts == {**lost, "malformed": 1, "copies": 1} and sum(counts.values()) == 20


def test_counts_take_no_scan_of_their_own(spark, data):
    from pyspark.sql import Observation

    seen = Observation()
    plan = data.zone_cube(Observation())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectMetrics") == 1 and plan.count("Scan text") <= data.zone_cube()._jdf.queryExecution().executedPlan().toString().count("Scan text")
    shuffled = TripData(data.trips, data.stations, max_broadcast_rows=0)
    again = Observation()
    assert data.with_zone_cube(seen).cube.count() == shuffled.with_zone_cube(again).cube.count()
    assert seen.get == again.get and sum(seen.get.values()) == data.trips.count()


def test_bad_date_text_gives_null_not_failure(spark, tmp_path):
    p = tmp_path / "bad_dates.json"
    p.write_text('{"_id": {"$oid": "x1"}, "idplug_station": 2, "idunplug_station": 20, '
                 '"unplug_hourTime": {"$date": "not a date"}}\n'
                 '{"_id": {"$oid": "x2"}, "idplug_station": 2, "idunplug_station": 20, '
                 '"unplug_hourTime": {"$date": "2018-02-30T10:00:00.000+0100"}}\n')
    got = rows(load_trips(spark, str(p)), "trip_id", "trip_date", "trip_hour")
    assert got == [("x1", None, None), ("x2", None, 10)]


def test_to_pandas_brings_the_whole_result(spark, data):
    from pedalflow.plans import flows
    from pedalflow.sources import to_pandas

    assert len(to_pandas(flows.zone_balance(data))) == flows.zone_balance(data).count()


def test_batch_job_cli(spark, tmp_path, capsys):
    from pedalflow.plans.job import main

    out = str(tmp_path / "cli")
    main(["--stations", STATION_CSV, "--out", out, "--study", "zone_balance", "--study", "daily_peak_by_zone",
          "--years", "2018", "--format", "csv", *TRIP_FILES])
    printed = capsys.readouterr().out.split()
    assert "zone_balance" in printed and "daily_peak_by_zone" in printed
    bal = spark.read.option("header", True).csv(f"{out}/zone_balance")
    assert {r["year"] for r in bal.collect()} == {2018}


def test_gzip_export_spread_before_parsing(spark, tmp_path):
    import gzip

    gz = tmp_path / "trips_2017.json.gz"
    with open(TRIP_FILES[0], "rb") as src, gzip.open(gz, "wb") as dst:
        dst.write(src.read())
    raw = read_trips_json(spark, str(gz), parse_partitions=4)
    assert raw.rdd.getNumPartitions() == 4
    assert "RoundRobinPartitioning(4)" in raw._jdf.queryExecution().executedPlan().toString()
    assert rows(load_trips(spark, str(gz), parse_partitions=4), "trip_id") == rows(
        load_trips(spark, TRIP_FILES[0]), "trip_id")
