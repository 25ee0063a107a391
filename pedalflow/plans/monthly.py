"""A trip table that takes one monthly export after the other (A4, G2, D16 without a reload).

The exports overlap: a record can stand in two months' files, and the data set is their
set union.  ``TripStore`` keeps that set and the daily zone cube up to date while the
work of a load depends on the months that the load has trips of, not on all
that was loaded before:

* Every record has a 128-bit digest of its whole content, kept beside the trip.  Copies
  of a record carry the same date, so a new export only has to be compared with the
  digests of the months it touches: the anti-join reads two columns of those folders.
* New records are written to their month's folder under the name of the load.  Writing
  is a dynamic partition overwrite, so a load that is run again (after a failure, or with
  a corrected file) replaces what it wrote and nothing else.
* The cube is a folder per month.  A day's rows depend on that day's trips alone, so the
  touched months are counted anew from the stored trips and overwritten; all others stay.

Months can arrive in any order.  Malformed lines and records without a date go to the
quarantine with the reason.  One load runs at a time.

    <path>/trips/ym=2017-04/load=<name>/    canonical trips and their digest
    <path>/cube/ym=2017-04/                 daily zone cube
    <path>/quarantine/load=<name>/          lines and records set aside
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CORRUPT_COLUMN
from ..session import ensure_checkpoint_dir
from ..sources.trips import QUARANTINE_REASON, normalise_trips, read_trips_json, with_reason
from .data import TripData

#: The record's digest and its month; a trip's folder names the load that brought it.
DIGEST, MONTH, LOAD = "digest", "ym", "load"


def record_digest(columns: Sequence[str]) -> Column:
    """128 bits of the whole record.  Fields keep their names, so a value in another field is another record."""
    return F.unhex(F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))))


@dataclass(frozen=True)
class LoadCounts:
    """What became of an export's lines; they add up: n_lines = n_new + n_copies + n_malformed + n_no_date."""

    n_lines: int
    n_new: int
    n_copies: int
    n_malformed: int
    n_no_date: int
    months: tuple[str, ...]


class TripStore:
    def __init__(self, spark: SparkSession, path: str, stations: DataFrame, **options):
        """``stations`` are station rows; ``options`` go to ``TripData``."""
        self.spark, self.stations, self.options = spark, stations, options
        self._schema: T.StructType | None = None
        self._memo: dict = {}  # the stations are measured once
        self.trips_dir, self.cube_dir = os.path.join(path, "trips"), os.path.join(path, "cube")
        self.quarantine_dir, self.staging_dir = os.path.join(path, "quarantine"), os.path.join(path, "staging")
        ensure_checkpoint_dir(spark)

    # -- loading ---------------------------------------------------------------------

    def load_files(self, paths: str | Sequence[str], load: str, parse_partitions: int | None = None) -> LoadCounts:
        """Adds the records of one export (NDJSON files)."""
        return self.load_raw(read_trips_json(self.spark, paths, parse_partitions=parse_partitions), load)

    def load_raw(self, raw: DataFrame, load: str) -> LoadCounts:
        """Adds parsed lines (``read_trips_json``, ``parse_trip_lines``)."""
        raw = with_reason(raw)
        fields = [c for c in raw.columns if c not in (QUARANTINE_REASON, CORRUPT_COLUMN, "source_file")]
        parsed, part, seen = os.path.join(self.staging_dir, f"parsed-{load}"), F.col(QUARANTINE_REASON), Observation()
        counted = raw.observe(
            seen, F.count(F.lit(1)).alias("n_lines"),
            F.count_if(part == "malformed").alias("n_malformed"), F.count_if(part == "no_date").alias("n_no_date"),
        )
        # the lines are parsed once; what is set aside and what is not are folders of one write
        counted.write.mode("overwrite").partitionBy(QUARANTINE_REASON).parquet(parsed)
        raw = self.spark.read.schema(raw.schema).parquet(parsed)
        raw.filter(part != "good").write.mode("overwrite").json(os.path.join(self.quarantine_dir, f"{LOAD}={load}"))
        good = raw.filter(part == "good").withColumn(DIGEST, record_digest(fields))
        return self._add(normalise_trips(good, keep=[DIGEST]), load, seen)

    def load_trips(self, trips: DataFrame, load: str) -> LoadCounts:
        """Adds canonical trips; a record is the whole row.  Those without a date go to the quarantine."""
        undated, seen = F.col("trip_date").isNull(), Observation()
        aside = trips.filter(undated).withColumn(QUARANTINE_REASON, F.lit("no_date"))
        aside.write.mode("overwrite").json(os.path.join(self.quarantine_dir, f"{LOAD}={load}"))
        counted = trips.withColumn(DIGEST, record_digest(trips.columns)).observe(
            seen, F.count(F.lit(1)).alias("n_lines"),
            F.count_if(F.lit(False)).alias("n_malformed"), F.count_if(undated).alias("n_no_date"),
        )
        return self._add(counted.filter(~undated), load, seen)

    def _add(self, trips: DataFrame, load: str, seen: Observation) -> LoadCounts:
        staged = os.path.join(self.staging_dir, f"staged-{load}")
        month = F.date_format("trip_date", "yyyy-MM").alias(MONTH)
        # copies inside the export collapse map-side; a hot record is one row a task
        trips.select("*", month).dropDuplicates([MONTH, DIGEST]).write.mode("overwrite").parquet(staged)
        rows = self.spark.read.parquet(staged)
        months = {r[MONTH] for r in rows.select(MONTH).distinct().collect()}  # a row per month of the export
        before = self._months_of(load)
        fresh, filled, n_new = self._new(rows, months, load), months, 0
        if before:  # run again: folders that it fills no longer go
            filled = {r[MONTH] for r in fresh.select(MONTH).distinct().collect()}
            for gone in before - filled:
                self._remove(os.path.join(self.trips_dir, f"{MONTH}={gone}", f"{LOAD}={load}"))
        if filled:
            added = Observation()
            fresh = fresh.withColumn(LOAD, F.lit(load)).observe(added, F.count(F.lit(1)).alias("n"))
            self._overwrite(fresh, self.trips_dir, MONTH, LOAD)
            n_new = added.get["n"]
        for again in before:  # a month may be empty now
            self._remove(os.path.join(self.cube_dir, f"{MONTH}={again}"))
        self._refresh(months | before)
        self._remove(self.staging_dir)
        n, bad, undated = (int(seen.get[c]) for c in ("n_lines", "n_malformed", "n_no_date"))
        return LoadCounts(n, n_new, n - bad - undated - n_new, bad, undated, tuple(sorted(months)))

    def _new(self, rows: DataFrame, months: set[str], load: str) -> DataFrame:
        """The records that no other load has brought: only folders of ``months`` are read, and two columns."""
        known = self._stored(months)
        if known is None:
            return rows
        return rows.join(known.filter(F.col(LOAD) != load).select(MONTH, DIGEST), [MONTH, DIGEST], "left_anti")

    def _refresh(self, months: set[str]) -> None:
        """Counts the cube of ``months`` anew from their stored trips."""
        stored = self._stored(months) if months else None
        if stored is None:
            return
        cube = self._data(stored).zone_cube().withColumn(MONTH, F.date_format("trip_date", "yyyy-MM"))
        self._overwrite(cube, self.cube_dir, MONTH)

    def rebuild_cube(self) -> None:
        """Counts the whole cube anew, for another station list."""
        self._remove(self.cube_dir)
        stored = self._stored()
        if stored is not None:
            cube = self._data(stored).zone_cube().withColumn(MONTH, F.date_format("trip_date", "yyyy-MM"))
            self._overwrite(cube, self.cube_dir, MONTH)

    def clear(self) -> None:
        for path in (self.trips_dir, self.cube_dir, self.quarantine_dir, self.staging_dir):
            self._remove(path)
        self._schema = None

    # -- reading ---------------------------------------------------------------------

    def data(self) -> TripData:
        """All trips and their cube; every study reads them as it reads a batch load."""
        stored = self._stored()
        if stored is None:
            raise ValueError("nothing has been loaded yet")
        cube = self.spark.read.parquet(self.cube_dir).drop(MONTH)
        return self._data(stored, cube=cube)

    def _data(self, stored: DataFrame, **more) -> TripData:
        return TripData(stored.drop(DIGEST, MONTH, LOAD), self.stations, **self.options, **more, _memo=self._memo)

    def _stored(self, months: set[str] | None = None) -> DataFrame | None:
        """Stored trips, of ``months`` only (other folders are not read); None if there are none."""
        if not self._exists(self.trips_dir):
            return None
        if self._schema is None:  # folder names are text: a load may be called 2017
            fields = self.spark.read.parquet(self.trips_dir).drop(MONTH, LOAD).schema.fields
            self._schema = T.StructType([*fields, T.StructField(MONTH, T.StringType()), T.StructField(LOAD, T.StringType())])
        stored = self.spark.read.schema(self._schema).parquet(self.trips_dir)
        return stored if months is None else stored.filter(F.col(MONTH).isin(sorted(months)))

    def _months_of(self, load: str) -> set[str]:
        """Months that have a folder of this load; names of folders only."""
        if not self._exists(self.trips_dir):
            return set()
        folders = self._path(os.path.join(self.trips_dir, f"{MONTH}=*", f"{LOAD}={load}"))
        found = folders.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(folders)
        return {str(f.getPath().getParent().getName()).split("=", 1)[1] for f in found or ()}

    # -- files -----------------------------------------------------------------------

    def _overwrite(self, df: DataFrame, path: str, *folders: str) -> None:
        """Writes ``df`` over the folders that it has rows for; others stay."""
        rows = df.hint("rebalance", *folders)  # about one file per 64 MB and folder, a hot month in several tasks
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _exists(self, path: str) -> bool:
        p = self._path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _remove(self, path: str) -> None:
        p = self._path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def main(argv: Sequence[str] | None = None) -> None:
    """``python -m pedalflow.plans.monthly --store s/ --stations stations.csv --load 2018-07 trips/201807.json``"""
    import argparse

    from ..sources.stations import read_stations_csv, station_rows

    p = argparse.ArgumentParser(description="Add one trip export to a store of trips and their daily zone cube")
    p.add_argument("trips", nargs="+", help="NDJSON files of the export (any Hadoop-FS URI)")
    p.add_argument("--store", required=True)
    p.add_argument("--stations", required=True, help="station list CSV")
    p.add_argument("--load", required=True, help="name of the export; loading it again replaces it")
    p.add_argument("--match", choices=["normalised", "exact"], default="normalised")
    p.add_argument("--parse-partitions", type=int)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("pedalflow-monthly").getOrCreate()
    stations = station_rows(read_stations_csv(spark, a.stations), match=a.match)
    print(TripStore(spark, a.store, stations).load_files(a.trips, a.load, a.parse_partitions))


if __name__ == "__main__":
    main()
