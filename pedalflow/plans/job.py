"""Batch job: load the monthly exports once, run the studies, write their tables (A4, A12, §3.2).

    python -m pedalflow.plans.job --stations stations.csv --out results/ trips/2017-*.json trips/2018-*.json

The exports are parsed once, in one write to ``<out>/parsed`` with a folder each for
good, malformed and undated records.  The good ones are de-duplicated and written as
year/month-partitioned Parquet under ``<out>/trips``; the others go to
``<out>/quarantine`` with the reason.  If a zone study is asked for, one scan of the
trip table builds the daily zone cube (``TripData.with_zone_cube``) from which all
zone studies are answered, and one more the histogram for the rider studies; the station
studies scan the trip table.  Each study writes its chart-ready table under
``<out>/<study>``, partitioned by year where it has one.  ``<out>/counts`` says what
became of every line: malformed, without a date, a copy, or a trip that was kept or that the zone
lookup lost; the numbers are observed while the job writes, without a scan of their own.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import RUNTIME_CONF, ensure_checkpoint_dir
from ..sources.sinks import counts_table, write_quarantine, write_table
from ..sources.stations import read_stations_csv, station_rows
from ..sources.trips import QUARANTINE_REASON, read_trips_json, trips_from_raw, with_reason
from . import calendar_studies as cal
from . import flows, riders, zone_stats
from .data import TripData

Study = Callable[[TripData, Sequence[int] | None], DataFrame]

# The studies the cluster job ran, plus the rest of the catalogue that reads only trips.
STUDIES: dict[str, Study] = {
    "trips_by_weekday_year": lambda d, y: cal.trips_by_weekday_year(d, years=y),
    "trips_by_weekday_year_by_zone": lambda d, y: cal.trips_by_weekday_year(d, by_zone=True, years=y),
    "trips_by_week_year": lambda d, y: cal.trips_by_week_year(d, years=y),
    "zone_stats": lambda d, y: zone_stats.zone_stats(d, "all", years=y),
    "zone_stats_weekend": lambda d, y: zone_stats.zone_stats(d, "weekend", years=y),
    "zone_stats_season": lambda d, y: zone_stats.zone_stats(d, "season", years=y),
    "zone_extremes": lambda d, y: zone_stats.zone_extremes(d, "all", years=y),
    "zone_balance": lambda d, y: flows.zone_balance(d, years=y),
    "zone_in_out_demand": lambda d, y: flows.zone_in_out_demand(d),
    "growth_by_year": lambda d, y: cal.growth_by_year(d),
    "daily_peak_by_zone": lambda d, y: cal.daily_peak_by_zone(d),
    "station_balance": lambda d, y: flows.station_balance(d),
    "od_weekday_top": lambda d, y: flows.od_weekday_top(d, 10),
    "usage_by_age": lambda d, y: riders.usage_by_age(d),
    "above_average_share": lambda d, y: riders.above_average_share(d),
    "travel_time_by_age_summary": lambda d, y: riders.travel_time_by_age_summary(d),
}


# Studies that read the daily zone cube.
ZONE_STUDIES = frozenset(
    "trips_by_weekday_year trips_by_weekday_year_by_zone trips_by_week_year zone_stats zone_stats_weekend "
    "zone_stats_season zone_extremes zone_balance daily_peak_by_zone".split()
)

# Studies that read the rider histogram.
RIDER_STUDIES = frozenset("usage_by_age above_average_share travel_time_by_age_summary".split())


def run_studies(
    spark: SparkSession,
    trip_paths: Sequence[str],
    station_csv: str,
    out: str,
    studies: Sequence[str] | None = None,
    years: Sequence[int] | None = None,
    match: str = "normalised",
    fmt: str = "parquet",
    dedupe_partitions: int | None = None,
    parse_partitions: int | None = None,
) -> dict[str, str]:
    """Run the studies; returns ``{study: output path}``."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    names = list(studies or STUDIES)
    ensure_checkpoint_dir(spark)  # a missing setting fails here, not after the load
    raw = with_reason(read_trips_json(spark, trip_paths, parse_partitions=parse_partitions))
    parsed = os.path.join(out, "parsed")
    part, lines, zones = F.col(QUARANTINE_REASON), Observation(), Observation()
    reasons = ("malformed", "no_date", "good")
    counted = raw.observe(lines, *[F.count_if(part == r).alias(r) for r in reasons])
    counted.write.mode("overwrite").partitionBy(QUARANTINE_REASON).parquet(parsed)
    counts = {"malformed": lines.get["malformed"], "no_date": lines.get["no_date"]}
    raw = spark.read.schema(raw.schema).parquet(parsed)
    bad = F.col(QUARANTINE_REASON) != "good"
    write_quarantine(raw.filter(bad), os.path.join(out, "quarantine"))
    good = raw.filter(~bad).drop(QUARANTINE_REASON)
    loaded = TripData(trips_from_raw(good), station_rows(read_stations_csv(spark, station_csv), match=match))
    data = loaded.materialise(os.path.join(out, "trips"), shuffle_partitions=dedupe_partitions)
    if ZONE_STUDIES.intersection(names):
        data = data.with_zone_cube(counts=zones)  # one more scan; every zone study then reads the cube
        counts |= zones.get
        counts["copies"] = lines.get["good"] - sum(v or 0 for v in zones.get.values())
    if RIDER_STUDIES.intersection(names):
        data = data.with_rider_cube()
    write_table(counts_table(spark, {k: v for k, v in counts.items() if v}), os.path.join(out, "counts"), fmt=fmt)
    written = {}
    for name in names:
        df = STUDIES[name](data, years)
        path = os.path.join(out, name)
        write_table(df, path, partition_by=["year"] if "year" in df.columns else [], fmt=fmt)
        written[name] = path
    return written


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("trips", nargs="+", help="NDJSON trip files or folders (any Hadoop-FS URI)")
    p.add_argument("--stations", required=True, help="station list CSV")
    p.add_argument("--out", required=True)
    p.add_argument("--study", action="append", choices=sorted(STUDIES), help="run only these studies")
    p.add_argument("--years", type=int, nargs="*")
    p.add_argument("--match", choices=["normalised", "exact"], default="normalised")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    p.add_argument("--dedupe-partitions", type=int, help="shuffle partitions of the one-off de-duplication")
    p.add_argument("--parse-partitions", type=int,
                   help="spread lines over this many tasks before parsing (large non-splittable exports)")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("pedalflow-studies").getOrCreate()
    for name, path in run_studies(
        spark, a.trips, a.stations, a.out, a.study, a.years, a.match, a.format, a.dedupe_partitions,
        a.parse_partitions,
    ).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
