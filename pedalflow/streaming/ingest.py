"""Monthly trip exports as a file stream (A4 run incrementally).

New NDJSON files dropped into a folder are parsed with the declared schema and land
as Parquet, partitioned by ``part``: ``good``, ``malformed`` or ``no_date`` records.
The stream keeps no state and no watermark, so nothing is ever too late: a back-fill of
any age, in any order, lands like every other file.  Each micro-batch overwrites its own
folder ``batch_id=<n>``, so a batch replayed after a failure lands once.

Duplicates are removed over whole records when the landed table is read
(``landed_trips``), exactly as the batch load does, so the studies on it give the
batch's answers whatever the order of arrival.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import CORRUPT_COLUMN, TRIP_JSON_SCHEMA
from ..session import ensure_checkpoint_dir
from ..sources.trips import QUARANTINE_REASON, parse_trip_lines, trips_from_raw, with_reason


def trip_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming raw records of NDJSON files, with the reason where one is set aside."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(folder)
    return with_reason(parse_trip_lines(lines))


def start_landing(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str | None = None,
    available_now: bool = False,
    max_files_per_trigger: int = 100,
) -> StreamingQuery:
    """Land what arrives in ``folder`` under ``out``; ``available_now`` stops when all of it has landed."""
    if checkpoint is None:
        checkpoint = os.path.join(ensure_checkpoint_dir(spark), "streams", "landing")

    def land(batch: DataFrame, batch_id: int) -> None:
        path = os.path.join(out, f"batch_id={batch_id}")
        batch.write.mode("overwrite").partitionBy(QUARANTINE_REASON).parquet(path)

    stream = trip_stream(spark, folder, max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def landed(spark: SparkSession, out: str) -> DataFrame:
    """Every landed record with its ``part`` and ``batch_id``."""
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in TRIP_JSON_SCHEMA.fields if f.dataType.typeName() != "struct"]
    schema = ", ".join(
        [
            "`_id` struct<`$oid`:string>",
            "`unplug_hourTime` struct<`$date`:string>",
            *columns,
            f"`{CORRUPT_COLUMN}` string",
            "batch_id long",
            f"{QUARANTINE_REASON} string",
        ]
    )
    return spark.read.schema(schema).parquet(out)


def landed_trips(spark: SparkSession, out: str) -> DataFrame:
    """Canonical trips of the landed good records, as a set."""
    good = landed(spark, out).filter(F.col(QUARANTINE_REASON) == "good")
    return trips_from_raw(good.drop("batch_id", QUARANTINE_REASON))


def landed_quarantine(spark: SparkSession, out: str) -> DataFrame:
    """Landed records that were set aside, with the reason."""
    return landed(spark, out).filter(F.col(QUARANTINE_REASON) != "good")


def main(argv=None) -> None:
    """``python -m pedalflow.streaming.ingest --folder in/ --out landed/``"""
    import argparse

    p = argparse.ArgumentParser(description="Land NDJSON trip exports as they arrive")
    p.add_argument("--folder", required=True, help="folder that receives NDJSON trip exports")
    p.add_argument("--out", required=True, help="output folder (one sub-folder per micro-batch)")
    p.add_argument("--checkpoint", help="stream checkpoint folder (default: under spark.checkpoint.dir)")
    p.add_argument("--once", action="store_true", help="land what is there and stop")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("pedalflow-stream").getOrCreate()
    start_landing(spark, a.folder, a.out, a.checkpoint, available_now=a.once).awaitTermination()


if __name__ == "__main__":
    main()
