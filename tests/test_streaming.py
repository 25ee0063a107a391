import json
import os
import shutil

from conftest import TRIP_FILES, rows

from pedalflow.plans import calendar_studies as cal
from pedalflow.plans import flows, zone_stats
from pedalflow.plans.data import TripData
from pedalflow.plans.registry import finish
from pedalflow.sources.trips import load_trips
from pedalflow.streaming import landed, landed_quarantine, landed_trips, start_landing


def _land(spark, tmp_path, files, **options):
    src = tmp_path / "in"
    src.mkdir()
    for i, text in enumerate(files):
        (src / f"{i}.json").write_text(text)
        os.utime(src / f"{i}.json", (1_000_000_000 + i, 1_000_000_000 + i))  # order of arrival
    out = str(tmp_path / "out")
    q = start_landing(spark, str(src), out, str(tmp_path / "ckpt"), available_now=True, **options)
    q.awaitTermination(120)
    return str(src), out


def test_landed_trips_answer_the_studies(spark, data, tmp_path):
    texts = [open(p, encoding="utf-8").read() for p in TRIP_FILES]
    _, out = _land(spark, tmp_path, texts)
    streamed = TripData(landed_trips(spark, out), data.stations)
    assert rows(streamed.trips) == rows(data.trips)
    for fn in (lambda d: zone_stats.zone_stats(d, "season"), flows.zone_balance, cal.daily_peak_by_zone):
        assert sorted(finish(fn(streamed)).collect()) == sorted(finish(fn(data)).collect())


def _record(i, day, station=90):
    return json.dumps(
        {"_id": {"$oid": i} if i else None, "travel_time": 60, "ageRange": 1, "user_type": 1, "idplug_station": 66,
         "idunplug_station": station, "unplug_hourTime": {"$date": f"{day}T00:30:00.000+0200"}}
    )


def test_months_out_of_order_lose_nothing(spark, tmp_path):
    """Five months, one file a batch, the oldest arriving fourth; copies, records without id, bad lines and dates."""
    months = [
        [_record("a", "2018-06-03"), _record("b", "2018-06-04")],
        [_record("c", "2018-05-01"), _record("a", "2018-06-03")],
        [_record("d", "2019-01-01"), "{broken", _record(None, "2018-06-03", 1)],
        [_record("e", "2017-04-02"), _record("f", "2017-04-03"), _record(None, "2017-04-03", 2)],
        [_record("g", "no date"), _record("e", "2017-04-02"), _record("h", "2016-02-29")],
    ]
    src, out = _land(spark, tmp_path, ["\n".join(m) + "\n" for m in months], max_files_per_trigger=1)
    assert landed(spark, out).select("batch_id").distinct().count() == 5
    streamed = landed_trips(spark, out)
    batch = load_trips(spark, src).filter("trip_date IS NOT NULL")
    assert sorted(streamed.collect(), key=repr) == sorted(batch.collect(), key=repr) and streamed.count() == 9
    assert sorted(r["part"] for r in landed_quarantine(spark, out).collect()) == ["malformed", "no_date"]


def test_a_replayed_folder_lands_once(spark, tmp_path):
    src, out = _land(spark, tmp_path, [_record("a", "2018-06-03")])
    shutil.copy(os.path.join(src, "0.json"), os.path.join(src, "again.json"))
    q = start_landing(spark, src, out, str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    assert landed(spark, out).count() == 2 and landed_trips(spark, out).count() == 1
