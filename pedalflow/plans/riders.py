"""Rider profiles: counts by attribute, travel time by age, above-average use
(D1, D7-D11, L16, L18, L23, S13).

The studies of age, travel time and user type read trips, or the histogram of
``TripData.with_rider_cube`` where there is one: a row then stands for ``w`` trips, and sums,
means, shares and quartiles are taken with that weight, which gives the same answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import UNKNOWN_AGE
from .data import TripData


def _riders(data: TripData, *columns: str) -> tuple[DataFrame, Column]:
    """Rows with ``columns`` and how many trips each stands for."""
    cube = data.rider_cube
    if cube is None or not set(columns) <= set(cube.columns):
        return data.trips.select(*columns), F.lit(1).cast("long")
    return cube, F.col("w")


def _time(w: Column) -> tuple[Column, Column]:
    """Total travel time and trips with a known one."""
    return F.sum(F.col("travel_time") * w), F.sum(F.when(F.col("travel_time").isNotNull(), w))


def count_by(data: TripData, column: str) -> DataFrame:
    """Trips per value of one attribute (D1), e.g. ``user_type``, ``age_range``, ``plug_base``."""
    rows, w = _riders(data, column)
    return rows.groupBy(column).agg(F.sum(w).alias("n_trips")).orderBy(column)


def usage_by_age(data: TripData, known_only: bool = False) -> DataFrame:
    """Per age range: trips, total and mean travel time, share of all travel time
    (L16, D7, D8).  ``known_only`` drops the unknown age code 0 (B13).

    One aggregate gives sum and mean together; the share window runs over the
    per-age rows only.
    """
    t, w = _riders(data, "age_range", "travel_time")
    if known_only:
        t = t.filter(F.col("age_range") != UNKNOWN_AGE)
    total, known = _time(w)
    per_age = t.groupBy("age_range").agg(
        F.sum(w).alias("n_trips"),
        total.alias("total_travel_time"),
        F.try_divide(total, known).alias("mean_travel_time"),
    )
    return per_age.withColumn(
        "share_of_total", F.try_divide(F.col("total_travel_time"), F.sum("total_travel_time").over(Window.partitionBy()))
    ).orderBy("age_range")


def mean_travel_time_floor(data: TripData):
    """Whole-number mean travel time, ``floor(sum / count)`` over known travel times.

    Returned as a scalar-subquery column so it stays inside the plan.
    """
    rows, w = _riders(data, "travel_time")
    return rows.select(F.floor(F.try_divide(*_time(w))).alias("mean_floor")).scalar()


def travel_time_totals(data: TripData) -> DataFrame:
    """One row: trips, trips with a known travel time, total and floored mean travel time."""
    rows, w = _riders(data, "travel_time")
    total, known = _time(w)
    return rows.agg(
        F.coalesce(F.sum(w), F.lit(0)).alias("n_trips"),
        F.coalesce(known, F.lit(0)).alias("n_known"),
        total.alias("total_travel_time"),
        F.floor(F.try_divide(total, known)).alias("mean_floor"),
    )


def above_average_share(data: TripData) -> DataFrame:
    """Per age range: trips longer than the global (floored) mean, all trips, and their share
    (D10, D11).  Trips without a travel time are never above the mean."""
    mean = mean_travel_time_floor(data)
    above = F.coalesce((F.col("travel_time") - mean) > 0, F.lit(False))
    rows, w = _riders(data, "age_range", "travel_time")
    return (
        rows.select("age_range", above.alias("above"), w.alias("n"))
        .groupBy("age_range")
        .agg(
            F.sum(F.when(F.col("above"), F.col("n")).otherwise(0)).alias("n_above"),
            F.sum("n").alias("n_trips"),
        )
        .withColumn("share_above", F.try_divide(F.col("n_above"), F.col("n_trips")))
    )


def above_average_by_age(data: TripData) -> DataFrame:
    """Per age range, trips longer than the global (floored) mean; ranges without any are
    absent (L18, as filter-then-count does)."""
    return above_average_share(data).filter(F.col("n_above") > 0).select("age_range", "n_above")


def travel_time_by_age_summary(data: TripData) -> DataFrame:
    """Bounded distribution summary per age range instead of collecting raw rows (L23):
    trips, min, max and exact quartiles (linear interpolation) of travel time.

    Trips are first counted per (age range, travel time) -- a map-side partial
    aggregate -- and the quartiles are taken over those weighted values, so a
    huge age group costs one row per distinct travel time, not one per trip.
    """
    rows, w = _riders(data, "age_range", "travel_time")
    per_value = rows.groupBy("age_range", "travel_time").agg(F.sum(w).alias("w"))
    return (
        per_value.groupBy("age_range")
        .agg(
            F.sum("w").alias("n_trips"),
            F.min("travel_time").alias("min_travel_time"),
            F.max("travel_time").alias("max_travel_time"),
            F.percentile("travel_time", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("w")).alias("q"),
        )
        .select(
            "age_range",
            "n_trips",
            "min_travel_time",
            "max_travel_time",
            F.col("q").getItem(0).alias("p25_travel_time"),
            F.col("q").getItem(1).alias("p50_travel_time"),
            F.col("q").getItem(2).alias("p75_travel_time"),
        )
    )
