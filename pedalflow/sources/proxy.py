"""Trips and stations expressed over the driver's TPC-H-style tables.

The driver tables stand in for real trip exports so every study can be checked
against an independent SQL oracle and timed at growing scale factors:

* trips = ``lineitem``: ``l_orderkey`` trip id, ``l_linenumber - 1`` age range (so
  some ages are the unknown 0), ``l_returnflag`` user type, ``l_linestatus`` base,
  ``l_quantity`` travel time (13 stands for an unknown one), ``l_suppkey`` start
  station, ``l_partkey mod (S + S div 10)`` end station (S = number of suppliers,
  so about one destination in eleven matches no station), ``l_shipdate`` start time.
* stations = ``supplier``: ``s_suppkey`` station, ``s_nationkey -> n_name`` zone,
  ``n_regionkey -> r_name`` district, ``s_acctbal`` and ``s_nationkey`` the two
  coordinates.

So that every rule has rows it decides: stations ending in 0 form a zone that trips
only leave, those ending in 5 one that trips only reach, those ending in 7 a zone
without winter trips (moved to spring), and 1995 has no Sunday (moved to Monday).
``with_holes`` takes the dates of some trips and the zones of some stations away.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared schemas of the driver columns we read: no footer-based inference on
# every load, and the scan never exposes columns no study uses.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "part": "p_partkey BIGINT, p_brand STRING, p_size INT, p_retailprice DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def proxy_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical trip columns over ``lineitem`` (see module doc)."""
    li = table(spark, sf_dir, "lineitem")
    # Number of stations as a scalar subquery: stays inside the plan, no driver round trip.
    s = table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    ts = F.col("l_shipdate")
    start = F.when(F.col("l_suppkey") % 10 == 5, F.col("l_suppkey") + 1).otherwise(F.col("l_suppkey"))
    # S + S div 10 == floor(11 * S / 10): one reference to the subquery, planned once.
    li = li.withColumn("unplug_station", start).withColumn("end", F.col("l_partkey") % F.floor(s * 11 / 10))
    day = F.to_date(ts)
    day = F.when((F.col("unplug_station") % 10 == 7) & (F.month(day) <= 2), F.date_add(day, 60)).otherwise(day)
    day = F.when((F.year(day) == 1995) & (F.dayofweek(day) == 1), F.date_add(day, 1)).otherwise(day)
    return li.select(
        F.col("l_orderkey").alias("trip_id"),
        F.col("l_returnflag").alias("user_type"),
        (F.col("l_linenumber") - 1).alias("age_range"),
        F.when(F.col("l_quantity") != 13, F.col("l_quantity").cast("long")).alias("travel_time"),
        "unplug_station",
        F.when(F.col("end") % 10 == 0, F.col("end") + 1).otherwise(F.col("end")).alias("plug_station"),
        F.col("l_linestatus").alias("unplug_base"),
        F.col("l_linestatus").alias("plug_base"),
        day.alias("trip_date"),
        F.hour(ts).alias("trip_hour"),
    )


def proxy_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station rows (one per original station row) over ``supplier``/``nation``/``region``."""
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    last = F.col("s_suppkey") % 10
    # nation and region are fixed-size (25 / 5 rows): broadcasting them is bounded.
    return (
        sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey, "left")
        .join(F.broadcast(reg), nat.n_regionkey == reg.r_regionkey, "left")
        .select(
            F.col("s_suppkey").cast("string").alias("station_key"),
            F.col("s_suppkey").alias("station"),
            F.when(last == 0, "DEPARTURES ONLY")
            .when(last == 5, "ARRIVALS ONLY")
            .when(last == 7, "NO WINTER")
            .otherwise(F.col("n_name"))
            .alias("zone"),
            F.col("r_name").alias("district"),
            F.col("s_acctbal").cast("double").alias("lat"),
            F.col("s_nationkey").cast("double").alias("lon"),
            F.lit(None).cast("int").alias("docks"),
        )
    )


def with_holes(trips: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same trips and stations with some dates and some zones unknown: trips that took 7,
    stations ending in 3."""
    undated = F.coalesce(F.col("travel_time") == 7, F.lit(False))
    holed = trips.withColumn("trip_date", F.when(~undated, F.col("trip_date")))
    return holed, stations.withColumn("zone", F.when(F.col("station") % 10 != 3, F.col("zone")))


def event_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.ts`` as ISO text, the only driver table with real clock times (H4-H6)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("ts_text"),
    )


def part_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two numeric coordinates per point for the clustering study."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("station"),
        F.col("p_size").cast("double").alias("x"),
        F.col("p_retailprice").cast("double").alias("y"),
        F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int").alias("brand"),
    )
