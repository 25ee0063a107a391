"""Station sources: header CSV, literal rows, georss XML and KML.

Every reader ends in the same normalised *station rows* frame, one row per
original station row::

    station_key string, station long, zone string, district string,
    lat double, lon double, docks int

``station`` is the number the trips use.  Suffixed keys (``001 a``,
``020 ampliacion``) map to their leading number (S1); ``match='exact'``
reproduces the as-coded behaviour where such rows match no trip.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import exact_station_number, station_number
from ..schema import STATION_CSV_SCHEMA


def read_stations_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw station list: header CSV, every column text (A2)."""
    return spark.read.schema(STATION_CSV_SCHEMA).option("header", True).option("encoding", "UTF-8").csv(path)


def stations_from_rows(spark: SparkSession, rows: Iterable[Mapping[str, str]]) -> DataFrame:
    """Station list given as literal rows (A3), same columns as the CSV."""
    names = STATION_CSV_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], STATION_CSV_SCHEMA)


def _clean_text(c):
    # District names carry no-break spaces; fold them before trimming.
    return F.trim(F.regexp_replace(c, "\u00a0", " "))


def station_rows(raw: DataFrame, match: str = "normalised") -> DataFrame:
    """Normalised station rows from the raw CSV layout."""
    key = F.col("`Número`")
    if match == "normalised":
        number = station_number(key)
    elif match == "exact":
        number = exact_station_number(key)
    else:
        raise ValueError(f"unknown match mode {match!r}")
    return raw.select(
        key.alias("station_key"),
        number.alias("station"),
        _clean_text(F.col("Barrio")).alias("zone"),
        _clean_text(F.col("Distrito")).alias("district"),
        F.col("Latitud").try_cast("double").alias("lat"),
        F.col("Longitud").try_cast("double").alias("lon"),
        F.col("`Número de Plazas`").try_cast("int").alias("docks"),
    )


def read_station_points_xml(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Station points from an RSS/georss XML list (A8): ``title`` and ``point = 'lat lon'``."""
    raw = (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreNamespace", True)
        .option("inferSchema", False)
        .load(path)
    )
    parts = F.split(F.trim(F.col("point")), r"\s+")
    return raw.select(
        F.trim(F.col("title")).alias("name"),
        parts.getItem(0).try_cast("double").alias("lat"),
        parts.getItem(1).try_cast("double").alias("lon"),
    )


def read_station_points_kml(spark: SparkSession, path: str) -> DataFrame:
    """Station points from an (unzipped) KML file (A9): ``Placemark/Point/coordinates = 'lon,lat[,alt]'``."""
    raw = (
        spark.read.format("xml")
        .option("rowTag", "Placemark")
        .option("ignoreNamespace", True)
        .option("inferSchema", False)
        .load(path)
    )
    parts = F.split(F.trim(F.col("Point.coordinates")), ",")
    return raw.select(
        F.trim(F.col("name")).alias("name"),
        parts.getItem(1).try_cast("double").alias("lat"),
        parts.getItem(0).try_cast("double").alias("lon"),
    )
