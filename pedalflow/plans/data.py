"""The trip data set every study runs on: canonical trips + station rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import with_calendar
from ..operators.broadcast import MAX_BROADCAST_ROWS, is_bounded
from ..operators.zoning import station_map, zone_centroids, zone_trips
from ..sources.proxy import proxy_stations, proxy_trips
from ..sources.stations import read_stations_csv, station_rows
from ..sources.trips import load_trips


@dataclass
class TripData:
    trips: DataFrame  # canonical trip columns (schema.TRIP_COLUMNS)
    stations: DataFrame  # station rows (sources.stations)
    max_broadcast_rows: int = MAX_BROADCAST_ROWS  # beyond this the lookups are shuffle joins
    # "trips": every trip counts once.  "station_pairs": every trip counts
    # n(origin zone rows) x n(destination zone rows), the number the studied code got by
    # joining coordinates per station row (S2), computed without the fan-out.
    weighting: str = "trips"
    # Optional daily zone cube (see ``with_zone_cube``): when set, the zone studies
    # are served from it instead of scanning the trips.
    cube: DataFrame | None = field(default=None, repr=False, compare=False)
    # Optional rider histogram (see ``with_rider_cube``) that serves the rider studies.
    rider_cube: DataFrame | None = field(default=None, repr=False, compare=False)
    _memo: dict = field(default_factory=dict, repr=False, compare=False)

    @classmethod
    def from_proxy(cls, spark: SparkSession, sf_dir: str, **options) -> "TripData":
        return cls(proxy_trips(spark, sf_dir), proxy_stations(spark, sf_dir), **options)

    @classmethod
    def from_files(
        cls,
        spark: SparkSession,
        trip_paths: str | Sequence[str],
        station_csv: str,
        match: str = "normalised",
        dedupe: bool = True,
        parse_partitions: int | None = None,
        **options,
    ) -> "TripData":
        trips = load_trips(spark, trip_paths, dedupe=dedupe, parse_partitions=parse_partitions)
        return cls(trips, station_rows(read_stations_csv(spark, station_csv), match=match), **options)

    @classmethod
    def from_parquet(cls, spark: SparkSession, trips_path: str, stations: DataFrame) -> "TripData":
        """Trips written by ``materialise`` (partition columns ``year``, ``month`` included)."""
        return cls(spark.read.parquet(trips_path), stations)

    def materialise(self, path: str, shuffle_partitions: int | None = None) -> "TripData":
        """Write the canonical trips once as Parquet partitioned by year and month and
        continue from the written table.

        Loading NDJSON and removing duplicate records is a full shuffle; doing
        it once and studying the written table many times keeps that cost out
        of every study, cuts the lineage (the files live in a shared folder,
        so a lost executor does not force a reload), and lets year filters
        prune folders.

        ``shuffle_partitions`` sizes the de-duplication shuffle, the only one in the
        package whose volume grows with the raw input (about input bytes / 256 MB);
        the study aggregates are small and rely on AQE coalescing instead.
        """
        spark = self.trips.sparkSession
        t = self.trips.withColumns({"year": F.year("trip_date"), "month": F.month("trip_date")})
        before = spark.conf.get("spark.sql.shuffle.partitions")
        if shuffle_partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
        try:
            # Rebalancing by month lets AQE give a hot month to several tasks and pack small
            # months together: about one file per 64 MB instead of one per task and month.
            t.hint("rebalance", "year", "month").write.mode("overwrite").partitionBy("year", "month").parquet(path)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        # Same stations and options (weighting, broadcast bound, checked dimensions); no cube yet.
        kept = {k: v for k, v in self._memo.items() if k != "counted"}
        return replace(self, trips=spark.read.parquet(path), cube=None, rider_cube=None, _memo=kept)

    def dated(self, extended: bool = False) -> DataFrame:
        """Trips with calendar columns (L1).  Trips without a valid date take part in no
        study; ``undated`` has them and ``lost_rows`` counts them."""
        return with_calendar(self.trips.filter(F.col("trip_date").isNotNull()), extended=extended)

    def undated(self) -> DataFrame:
        """Trips set aside because they have no valid date."""
        return self.trips.filter(F.col("trip_date").isNull()).withColumn("reason", F.lit("no_date"))

    def dims_bounded(self) -> bool:
        """Whether the station rows are proven small enough to broadcast.

        The station map and the zone centroids are aggregates of the station
        rows, so they never have more rows: one check covers both.
        """
        if "bounded" not in self._memo:
            self._memo["bounded"] = is_bounded(self.stations.select("station", "zone"), self.max_broadcast_rows)
        return self._memo["bounded"]

    def _dim(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.dims_bounded() else df

    def station_lookup(self) -> DataFrame:
        """Station number -> zone, broadcast-hinted when the station rows are proven small."""
        return self._dim(station_map(self.stations))

    def centroids(self) -> DataFrame:
        """One row per zone (mean coordinate, station rows)."""
        return self._dim(zone_centroids(self.stations))

    def zoned(self, how: str = "inner") -> DataFrame:
        """Dated trips with ``origin_zone`` / ``dest_zone``: one row per trip with every trip
        column, however many stations there are (L2/L3 without the coordinate fan-out)."""
        return zone_trips(self.dated(), self.station_lookup(), how=how, prepared=True)

    def counted(self, how: str = "inner") -> DataFrame:
        """What the count-based studies read: calendar columns, ``origin_zone``, ``dest_zone``
        and the number of trips ``w`` of a row (or their as-coded weight, S2).

        With a broadcast station lookup a row is a trip.  With a shuffle join, trips are
        first collapsed per (start station, end station, day), combined map-side, so the
        joins move those rows and a hot station is one row per day and partner before it
        reaches a join.  The columns are the same.
        """
        keys = ["unplug_station", "plug_station", "trip_date", "dayofweek", "month", "weekofyear", "year"]
        dated = self.dated().select(*keys)
        if self.dims_bounded():
            dated = dated.withColumn("w", F.lit(1).cast("long"))
        else:
            dated = dated.groupBy(*keys).agg(F.count(F.lit(1)).alias("w"))
        z = zone_trips(dated, self.station_lookup(), how=how, prepared=True)
        if how == "inner" and self.weighting == "station_pairs":
            z = self._weigh(z)
        elif self.weighting not in ("trips", "station_pairs"):
            raise ValueError(f"unknown weighting {self.weighting!r}")
        return z.select("trip_date", "dayofweek", "month", "weekofyear", "year", "origin_zone", "dest_zone", "w")

    def _weigh(self, z: DataFrame) -> DataFrame:
        n = self.centroids().select("zone", "n_stations")
        return (
            z.join(n.select(F.col("zone").alias("origin_zone"), F.col("n_stations").alias("n_o")), "origin_zone")
            .join(n.select(F.col("zone").alias("dest_zone"), F.col("n_stations").alias("n_d")), "dest_zone")
            .withColumn("w", F.col("w") * F.col("n_o") * F.col("n_d"))
        )

    def departures(self, known_dest: bool = True) -> DataFrame:
        """Trips by origin zone and day: calendar columns, ``zone``, ``w``.  ``known_dest``
        leaves out trips whose end has no zone, as the zone studies do."""
        calendar = ["trip_date", "dayofweek", "month", "weekofyear", "year"]
        if self.cube is not None:
            n = F.col("n_out" if known_dest else "n_out_any")
            return self.cube.filter(n > 0).select(*calendar, "zone", n.alias("w"))
        z = self.counted() if known_dest else self.counted(how="left").filter(F.col("origin_zone").isNotNull())
        return z.select(*calendar, F.col("origin_zone").alias("zone"), "w")

    def zone_cube(self, counts: Observation | None = None) -> DataFrame:
        """The daily zone cube: one row per (day, zone), so days x zones rows.

        Departures and arrivals of trips with both ends known (``n_out``, ``n_in``) and
        departures whatever the end (``n_out_any``, for the daily peaks).  Trips are first
        summed per (day, origin, destination) map-side, then both ends are counted.  A
        day's rows depend on that day's trips alone.
        """
        calendar = ["trip_date", "dayofweek", "month", "weekofyear", "year"]
        zones = ["origin_zone", "dest_zone"]
        looked_up = self.counted(how="left")
        if counts is not None:
            o, d = F.col("origin_zone").isNull(), F.col("dest_zone").isNull()
            reasons = {"kept": ~o & ~d, "no_origin": o & ~d, "no_destination": ~o & d, "no_origin_no_destination": o & d}
            of = [F.sum(F.when(why, F.col("w")).otherwise(0)).alias(name) for name, why in reasons.items()]
            looked_up = looked_up.observe(counts, *of)
        plain = looked_up.groupBy(*calendar, *zones).agg(F.sum("w").alias("n"))
        both = F.col("origin_zone").isNotNull() & F.col("dest_zone").isNotNull()
        if self.weighting == "station_pairs":
            size = self.centroids().select("zone", "n_stations")
            weigh = {c: size.select(F.col("zone").alias(c), F.col("n_stations").alias(f"n_{c}")) for c in zones}
            plain = plain.join(weigh["origin_zone"], "origin_zone", "left").join(weigh["dest_zone"], "dest_zone", "left")
            known = F.when(both, F.col("n") * F.col("n_origin_zone") * F.col("n_dest_zone")).otherwise(0)
        else:
            known = F.when(both, F.col("n")).otherwise(0)
        zero = F.lit(0).cast("long")
        known = known.cast("long")
        ends = F.array(
            F.struct(F.col("origin_zone").alias("zone"), known.alias("n_out"), zero.alias("n_in"), F.col("n").alias("n_out_any")),
            F.struct(F.col("dest_zone").alias("zone"), zero.alias("n_out"), known.alias("n_in"), zero.alias("n_out_any")),
        )
        return (
            plain.select(*calendar, F.inline(ends))
            .filter(F.col("zone").isNotNull())
            .groupBy(*calendar, "zone")
            .agg(*[F.sum(c).alias(c) for c in ("n_out", "n_in", "n_out_any")])
        )

    def with_zone_cube(self, counts: Observation | None = None) -> "TripData":
        """Aggregate the zoned trips once into a daily zone cube and serve every zone study
        from it; the cube is checkpointed to the shared folder.  ``counts`` observes what the
        zone lookups lose in that same scan (``lost_rows`` of the dated trips)."""
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(self.trips.sparkSession)
        return replace(self, cube=self.zone_cube(counts).checkpoint(eager=True), _memo=dict(self._memo))

    def with_rider_cube(self) -> "TripData":
        """Count the trips once per (age range, travel time, user type) and serve the rider
        studies from that histogram: at most ages x travel times x user types rows, combined
        map-side, checkpointed to the shared folder."""
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(self.trips.sparkSession)
        cube = self.trips.groupBy("age_range", "travel_time", "user_type").agg(F.count(F.lit(1)).alias("w"))
        return replace(self, rider_cube=cube.checkpoint(eager=True), _memo=dict(self._memo))
