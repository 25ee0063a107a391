"""Explicit schemas and the fixed values the studies depend on.

Declaring the trip schema removes the schema-inference pass over every input
file and lets Catalyst prune nested columns down to ``unplug_hourTime.$date``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Trip records: one JSON object per line, Mongo-export style -------------
TRIP_JSON_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StructType([T.StructField("$oid", T.StringType())])),
        T.StructField("user_day_code", T.StringType()),
        T.StructField("idplug_base", T.LongType()),
        T.StructField("idplug_station", T.LongType()),
        T.StructField("idunplug_base", T.LongType()),
        T.StructField("idunplug_station", T.LongType()),
        T.StructField("travel_time", T.LongType()),
        T.StructField("ageRange", T.LongType()),
        T.StructField("user_type", T.LongType()),
        T.StructField("unplug_hourTime", T.StructType([T.StructField("$date", T.StringType())])),
        T.StructField("zip_code", T.StringType()),
    ]
)

CORRUPT_COLUMN = "_corrupt_record"

# --- Station list: CSV with a header, every field text ----------------------
STATION_CSV_COLUMNS = [
    "Número",
    "Gis_X",
    "Gis_Y",
    "Fecha de Alta",
    "Distrito",
    "Barrio",
    "Calle",
    "Nº Finca",
    "Tipo de Reserva",
    "Número de Plazas",
    "Longitud",
    "Latitud",
    "Direccion",
]
STATION_CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in STATION_CSV_COLUMNS])

# Normalised station dimension every study joins against.
STATION_DIM_SCHEMA = T.StructType(
    [
        T.StructField("station", T.LongType()),
        T.StructField("zone", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("docks", T.IntegerType()),
    ]
)

# Canonical trip columns produced by every trip source (JSON or proxy).
TRIP_COLUMNS = [
    "trip_id",
    "user_type",
    "age_range",
    "travel_time",
    "unplug_station",
    "plug_station",
    "unplug_base",
    "plug_base",
    "trip_date",
    "trip_hour",
]

# --- Fixed values (must equal the studied analysis) --------------------------
# Spark dayofweek numbering: 1 = Sunday ... 7 = Saturday.
WEEKDAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
# Weekend as intended by the analysis: Friday, Saturday, Sunday.
WEEKEND_DAYS = [6, 7, 1]
# Weekend as coded by the analysis: dayofweek >= 4 (Wednesday to Saturday).
WEEKEND_AS_CODED_MIN_DAY = 4
# Seasons by month: spring 3-6, summer 7-9, autumn 10-12, winter 1-2.
SEASONS = [("spring", 3, 6), ("summer", 7, 9), ("autumn", 10, 12), ("winter", 1, 2)]
# Unknown rider age is coded as 0.
UNKNOWN_AGE = 0
