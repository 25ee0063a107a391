"""Two-level statistics and their per-partition rescaling.

First trips are counted per (group, zone, unit) -- unit being a weekday or a
month -- then the counts are summarised per (group, zone).  Both steps are
plain aggregates with a map-side partial step, so a zone holding a third of
all trips only produces one partial row per task.  The rescaling formulas are
windows over the summarised rows (zones x groups), never over trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trip_count(df: DataFrame) -> Column:
    """Trips in a group: ``count(*)``, or the sum of the weight ``w`` when the frame
    carries one (as-coded station-pair weights, S2, or trips pre-collapsed per
    station pair and day before shuffle joins; see ``TripData.zoned``)."""
    return F.sum("w").cast("long") if "w" in df.columns else F.count(F.lit(1))


def unit_counts(df: DataFrame, group_cols: Sequence[str], zone_col: str, unit_col: str) -> DataFrame:
    return df.groupBy(*group_cols, zone_col, unit_col).agg(trip_count(df).alias("n_trips"))


def summarise_counts(counts: DataFrame, group_cols: Sequence[str], zone_col: str) -> DataFrame:
    """Mean, sample stddev (NULL for a single unit), min and max of the counts."""
    return counts.groupBy(*group_cols, zone_col).agg(
        F.avg("n_trips").alias("mean_trips"),
        F.stddev_samp("n_trips").alias("std_trips"),
        F.min("n_trips").alias("min_trips"),
        F.max("n_trips").alias("max_trips"),
        F.count(F.lit(1)).alias("n_units"),
    )


def minmax_scale(x: Column, w) -> Column:
    """(x - min) / (max - min) over the window; 0 when all values are equal."""
    lo, hi = F.min(x).over(w), F.max(x).over(w)
    return F.when(hi == lo, F.lit(0.0)).otherwise(F.try_divide(x - lo, hi - lo))


def add_relative_spread(stats: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """``std_scaled = std / mean * max(mean)`` per group (E1), ``spread = (max - min) / mean`` (E2),
    ``mean_scaled`` = min-max scaled mean per group (E4)."""
    w = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    mean = F.col("mean_trips")
    return stats.withColumns(
        {
            "std_scaled": F.try_divide(F.col("std_trips"), mean) * F.max(mean).over(w),
            "spread": F.try_divide(F.col("max_trips") - F.col("min_trips"), mean),
            "mean_scaled": minmax_scale(mean, w),
        }
    )


def extremes(
    stats: DataFrame,
    group_cols: Sequence[str],
    zone_col: str = "zone",
    metrics: Sequence[str] = ("std_scaled", "spread"),
) -> DataFrame:
    """Zone(s) with the largest value of each metric per group (E3); ties are all kept,
    NULL values never win.  Rows ``(*group_cols, metric, zone, value, is_label)``;
    ``is_label`` marks the one tied zone a chart labels (first by zone name)."""
    long = stats.select(
        *group_cols,
        zone_col,
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        ).alias("m"),
    ).select(*group_cols, zone_col, "m.metric", "m.value")
    w = Window.partitionBy(*group_cols, "metric").orderBy(F.desc_nulls_last("value"))
    label = Window.partitionBy(*group_cols, "metric").orderBy(zone_col)
    return (
        long.filter(F.col("value").isNotNull())
        .withColumn("rk", F.rank().over(w))
        .filter(F.col("rk") == 1)
        .withColumn("is_label", F.row_number().over(label) == 1)
        .drop("rk")
    )
