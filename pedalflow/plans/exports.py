"""Source round trips on data derived from the driver tables.

Each function writes the proxy trips or stations in the layout of the real
exports (Mongo-style NDJSON, the station CSV, georss XML, KML) into the shared
checkpoint folder, then reads it back through the real readers.  The write is
a Spark job over the whole table, so the work grows with the data.
"""

from __future__ import annotations

import os
import zlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.drift import drift_of_lines
from ..sources.proxy import proxy_stations, proxy_trips, table
from ..sources.sinks import counts_table
from ..sources.stations import (
    read_station_points_kml,
    read_station_points_xml,
    read_stations_csv,
    station_rows,
)
from ..sources.trips import RESCUED, good_rows, normalise_trips, parse_trip_lines, read_trips_json
from ..schema import CORRUPT_COLUMN, STATION_CSV_COLUMNS
from .data import TripData


def _export(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where an export of these tables is written: one place per source folder, overwritten by the next call."""
    return os.path.join(ensure_checkpoint_dir(spark), "exports", f"{name}-{zlib.crc32(sf_dir.encode()):08x}")


def trips_as_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proxy trips in the export layout; start time written as local text with ``+0200``."""
    t = proxy_trips(spark, sf_dir)
    stamp = F.concat(
        F.date_format(F.make_timestamp_ntz(
            F.year("trip_date"), F.month("trip_date"), F.dayofmonth("trip_date"),
            F.coalesce(F.col("trip_hour"), F.lit(0)), F.lit(0), F.lit(0)),
            "yyyy-MM-dd'T'HH:mm:ss.SSS"),
        F.lit("+0200"),
    )
    oid = F.concat_ws("-", F.col("trip_id").cast("string"), F.col("age_range").cast("string"))
    return t.select(
        F.struct(oid.alias("$oid")).alias("_id"),
        F.sha2(oid, 256).alias("user_day_code"),
        F.col("age_range").cast("long").alias("idplug_base"),
        F.col("plug_station").alias("idplug_station"),
        F.col("age_range").cast("long").alias("idunplug_base"),
        F.col("unplug_station").alias("idunplug_station"),
        F.col("travel_time"),
        F.col("age_range").cast("long").alias("ageRange"),
        F.ascii("user_type").cast("long").alias("user_type"),
        F.struct(stamp.alias("$date")).alias("unplug_hourTime"),
        F.lit("").alias("zip_code"),
        F.year("trip_date").alias("_year"),
    )


#: Lines of a compressed file, which one task reads whole.
LINES_PER_FILE = 100_000


def json_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the trips as NDJSON files and load them with the declared schema (A1, A4).

    The files are compressed: as plain text the export is many times the tables it comes from.
    """
    path = _export(spark, sf_dir, "trips-json")
    out = trips_as_json_records(spark, sf_dir).drop("_year").write.mode("overwrite")
    out.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).json(path)
    trips = normalise_trips(good_rows(read_trips_json(spark, path, with_source=False)))
    return trips.select(
        "trip_id", "user_type", "age_range", "travel_time", "unplug_station", "plug_station",
        "trip_date", "trip_hour",
    )


def _as_lines(rec: DataFrame, *others: str):
    """The records as JSON lines (``value``); ``others`` are columns that are kept beside the line.

    A generator makes the line, so that a filter on it does not write it a second time.
    """
    fields = [F.col(f"`{c}`") for c in rec.columns if c not in others]
    return rec.select(*others, F.explode(F.array(F.to_json(F.struct(*fields)))).alias("value"))


def quarantine_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips as export lines, and the same lines cut in half (every line malformed); good
    and quarantined lines per part (A7).  ``(part, n_good, n_quarantined)``.

    Each line is built once, goes intact and cut through the reader's parser, and is
    counted in one aggregate.
    """
    lines = _as_lines(trips_as_json_records(spark, sf_dir).drop("_year"))
    halves = F.expr("substring(value, 1, length(value) div 2)")
    both = lines.select(
        F.inline(
            F.array(
                F.struct(F.lit("clean").alias("part"), F.col("value")),
                F.struct(F.lit("damaged").alias("part"), halves.alias("value")),
            )
        )
    )
    bad = F.col(CORRUPT_COLUMN).isNotNull()
    return parse_trip_lines(both).groupBy("part").agg(
        F.count_if(~bad).alias("n_good"), F.count_if(bad).alias("n_quarantined")
    )


def _drifting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips as export lines (``source_file``, ``value``): trips before 1998 without ``track``, later ones with it."""
    rec = trips_as_json_records(spark, sf_dir)
    late = F.col("_year") >= 1998
    rec = rec.withColumn("source_file", F.when(late, "late").otherwise("early")).withColumn(
        "track", F.when(late, F.struct(F.col("idunplug_station").alias("from"), F.col("idplug_station").alias("to")))
    )
    return _as_lines(rec.drop("_year"), "source_file")


def rescued_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose ``track`` the declared schema does not know, and what it holds, from the rescued fields."""
    raw = parse_trip_lines(_drifting_lines(spark, sf_dir), rescue=True)
    track = lambda part: F.try_variant_get(RESCUED, f"$.track.{part}", "bigint").alias(f"track_{part}")
    trips = normalise_trips(good_rows(raw), keep=["source_file", RESCUED])
    return trips.select("trip_id", F.col("source_file").alias("part"), track("from"), track("to"))


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the zone lookups lose, counted in the scan that builds the zone cube (A11, L19): ``(reason, n_trips)``."""
    seen = Observation()
    data = TripData(proxy_trips(spark, sf_dir), proxy_stations(spark, sf_dir))
    data.with_zone_cube(counts=seen)
    return counts_table(spark, {k: v for k, v in seen.get.items() if v})


def schema_drift_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export lines whose columns drift -- trips before 1998 without ``track``, later ones with
    it, and one file of cut lines -- and the column report per file (A6, L22).

    NULL fields are left out of JSON lines.
    """
    # each line is written once and goes whole and, if late, cut into the report
    whole = F.struct("source_file", "value")
    half = F.struct(F.lit("cut").alias("source_file"), F.expr("substring(value, 1, length(value) div 2)").alias("value"))
    both = F.when(F.col("source_file") == "late", F.array(whole, half)).otherwise(F.array(whole))
    report = drift_of_lines(_drifting_lines(spark, sf_dir).select(F.inline(both)))
    return report.withColumnRenamed("source_file", "part")


def stations_as_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proxy stations in the station-list layout; every seventh key written with a suffix."""
    sup, nat, reg = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey, "left").join(
        F.broadcast(reg), nat.n_regionkey == reg.r_regionkey, "left"
    )
    key = F.when(F.col("s_suppkey") % 7 == 0, F.format_string("%03d a", F.col("s_suppkey"))).otherwise(
        F.col("s_suppkey").cast("string")
    )
    values = {
        "Número": key,
        "Gis_X": F.col("s_acctbal").cast("string"),
        "Gis_Y": F.col("s_nationkey").cast("string"),
        "Fecha de Alta": F.lit("43803"),
        "Distrito": F.concat(F.col("r_name"), F.lit("\u00a0")),
        "Barrio": F.col("n_name"),
        "Calle": F.col("s_name"),
        "Nº Finca": F.lit("1"),
        "Tipo de Reserva": F.lit("Publica"),
        "Número de Plazas": (F.col("s_nationkey") + 10).cast("string"),
        "Longitud": F.col("s_nationkey").cast("double").cast("string"),
        "Latitud": F.col("s_acctbal").cast("string"),
        "Direccion": F.col("s_name"),
    }
    return j.select(*[values[c].alias(c) for c in STATION_CSV_COLUMNS])


def write_station_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the proxy station list as a header CSV under the checkpoint folder; return its path."""
    path = _export(spark, sf_dir, "stations-csv")
    stations_as_csv_rows(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return path


def csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the station list as header CSV and load it into station rows."""
    return station_rows(read_stations_csv(spark, write_station_csv(spark, sf_dir)))


def xml_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write station points as georss ``<item>`` XML and read them back."""
    path = _export(spark, sf_dir, "stations-xml")
    sup = table(spark, sf_dir, "supplier")
    items = sup.select(
        F.col("s_name").alias("title"),
        F.concat_ws(" ", F.col("s_acctbal").cast("string"), F.col("s_nationkey").cast("double").cast("string")).alias("point"),
    )
    items.write.mode("overwrite").format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    return read_station_points_xml(spark, path)


def kml_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write station points as KML ``<Placemark>`` rows and read them back."""
    path = _export(spark, sf_dir, "stations-kml")
    sup = table(spark, sf_dir, "supplier")
    marks = sup.select(
        F.col("s_name").alias("name"),
        F.struct(
            F.concat_ws(",", F.col("s_nationkey").cast("double").cast("string"), F.col("s_acctbal").cast("string"), F.lit("0"))
            .alias("coordinates")
        ).alias("Point"),
    )
    marks.write.mode("overwrite").format("xml").option("rootTag", "Document").option("rowTag", "Placemark").save(path)
    return read_station_points_kml(spark, path)
