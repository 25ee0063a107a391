"""Trip sources: monthly NDJSON exports.

All monthly files are read by one scan with the declared schema, so files
whose columns drift (an extra ``track`` column in some months) line up by name
and no per-file schema-inference pass is run.  Malformed lines are kept in a
quarantine frame instead of failing the job or vanishing silently.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import date_of_text, hour_of_text
from ..schema import CORRUPT_COLUMN, TRIP_JSON_SCHEMA


def read_trips_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = TRIP_JSON_SCHEMA,
    with_source: bool = True,
    parse_partitions: int | None = None,
    rescue: bool = False,
) -> DataFrame:
    """Raw trip rows from one or many JSON-lines files (any Hadoop-FS URI).

    Lines are read as text and parsed with ``from_json`` in PERMISSIVE mode:
    a malformed line keeps its text in ``_corrupt_record``.  Parsing from the
    line text (rather than the JSON file reader) keeps counts and filters on
    the corrupt-record column valid without caching the input.  ``source_file`` gives lineage
    (``with_source``; it is non-deterministic for the analyser, so plans that
    feed scalar subqueries leave it out).

    Plain NDJSON splits by block, so a large file is read by many tasks.  A
    compressed export that cannot be split is read by one task; when such a file
    holds a large share of the trips, ``parse_partitions`` spreads its lines
    round-robin over that many tasks before the JSON parse (one shuffle of the
    raw text, paid only when asked for).
    """
    if isinstance(paths, str):
        paths = [paths]
    lines = spark.read.text(list(paths))
    if with_source:
        lines = lines.withColumn("source_file", F.input_file_name())
    if parse_partitions:
        lines = lines.repartition(parse_partitions)
    return parse_trip_lines(lines, schema, rescue)


#: Fields of a record that the declared schema does not know, as one VARIANT object.
RESCUED = "rescued"


def rescued_fields(schema: T.StructType) -> Column:
    """The top-level fields of the JSON text ``value`` that ``schema`` does not have; NULL if there are none."""
    fields = F.try_parse_json("value").cast("map<string, variant>")
    others = F.map_filter(fields, lambda k, _: ~k.isin(*schema.fieldNames()))
    # as a lambda variable, so that a line is parsed once
    return F.transform(F.array(others), lambda o: F.when(F.size(o) > 0, F.to_variant_object(o)))[0]


def parse_trip_lines(lines: DataFrame, schema: T.StructType = TRIP_JSON_SCHEMA, rescue: bool = False) -> DataFrame:
    """Parse a frame of text lines (``value`` column, batch or streaming) into raw trip
    columns plus ``_corrupt_record``; blank lines are skipped, other columns kept.

    ``rescue`` adds ``rescued``, what the lines have beside the declared schema, for one
    more parse of each line.

    Each line is parsed once: as rows that a generator makes, the parsed columns are computed
    before any filter on them (``good_rows``) and not once more in that filter.
    """
    if rescue:
        lines = lines.withColumn(RESCUED, rescued_fields(schema))
    parse_schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    parsed = F.from_json("value", parse_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    others = [c for c in lines.columns if c != "value"]
    return lines.filter(F.trim("value") != "").select(F.inline(F.array(parsed)), *others)


def good_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def quarantine(raw: DataFrame) -> DataFrame:
    """Malformed lines with the file they came from."""
    return raw.filter(F.col(CORRUPT_COLUMN).isNotNull()).select("source_file", CORRUPT_COLUMN)


#: Why a raw row is set aside, or "good".
QUARANTINE_REASON = "part"


def with_reason(raw: DataFrame) -> DataFrame:
    """Raw rows with ``part``: ``malformed`` lines, ``no_date`` records, or ``good``."""
    dated = date_of_text(F.col("unplug_hourTime").getField("$date")).isNotNull()
    reason = F.when(F.col(CORRUPT_COLUMN).isNotNull(), "malformed").when(~dated, "no_date").otherwise("good")
    return raw.withColumn(QUARANTINE_REASON, reason)


def normalise_trips(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical trip columns from the raw JSON layout, and the columns ``keep`` as they are.

    ``trip_date`` is the calendar date written in the text (offset ignored),
    ``trip_hour`` the hour written in the text.
    """
    text = F.col("unplug_hourTime").getField("$date")
    return raw.select(
        F.col("_id").getField("$oid").alias("trip_id"),
        F.col("user_type").cast("int").alias("user_type"),
        F.col("ageRange").cast("int").alias("age_range"),
        F.col("travel_time"),
        F.col("idunplug_station").alias("unplug_station"),
        F.col("idplug_station").alias("plug_station"),
        F.col("idunplug_base").alias("unplug_base"),
        F.col("idplug_base").alias("plug_base"),
        date_of_text(text).alias("trip_date"),
        hour_of_text(text).alias("trip_hour"),
        F.col("zip_code"),
        F.col("user_day_code"),
        *keep,
    )


def load_trips(
    spark: SparkSession,
    paths: str | Sequence[str],
    dedupe: bool = True,
    parse_partitions: int | None = None,
) -> DataFrame:
    """All files as one set of canonical trips (set union when ``dedupe``, S11).

    Duplicate lines are removed over the whole record; ``dropDuplicates`` is
    an aggregate with a map-side partial step, so a large group of copies
    collapses before the shuffle.
    """
    raw = read_trips_json(spark, paths, with_source=False, parse_partitions=parse_partitions)
    return trips_from_raw(raw, dedupe)


def trips_from_raw(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    """Canonical trips from already parsed raw rows (good rows only, set union when ``dedupe``)."""
    good = good_rows(raw)
    if "source_file" in good.columns:
        good = good.drop("source_file")
    if dedupe:
        good = good.dropDuplicates()
    return normalise_trips(good)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union frames whose columns differ (G1, S12): matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_dedupe(frames: Sequence[DataFrame], subset: Sequence[str] | None = None) -> DataFrame:
    """Set union."""
    merged = union_by_name(frames)
    return merged.dropDuplicates(list(subset)) if subset else merged.dropDuplicates()
