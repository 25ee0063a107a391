"""Result sinks (A12): chart-ready study tables instead of images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    mode: str = "overwrite",
) -> None:
    """Write a study result; one folder per year when partitioned by ``year``.

    Study results are small (zones x years), so they are written as they come
    out of the final aggregate; no repartitioning is forced.
    """
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def to_pandas(df: DataFrame):
    """A study result on the driver (A10).  Results are aggregates (zones x years, weekdays x
    years); raw tables are written with ``write_table`` instead."""
    return df.toPandas()


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Input set aside (malformed lines, trips without a date), kept as JSON for inspection."""
    bad.write.mode("overwrite").json(path)


def counts_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Counts that a job has observed while it wrote its tables: ``(reason, n_trips)``, a row each."""
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "reason string, n_trips long")
