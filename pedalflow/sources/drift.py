"""Schema-drift report over many JSON-lines files.

Instead of one schema-inference job per file on the driver, every line is parsed once
and reduced to its shape, the text of its whole nested schema.  Lines of one shape are
counted per file, map-side, so what is shuffled is a row per file and shape, not per line and key.
The shapes are then taken apart into their paths (``track.from``, ``stops[].dock``)
and the types found there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CORRUPT = "_corrupt_record"


def schema_drift(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``drift_of_lines`` over one or many JSON-lines files or folders (any Hadoop-FS path)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return drift_of_lines(spark.read.text(paths).withColumn("source_file", F.input_file_name()))


def paths_of(shape: str) -> list[tuple[str, str]]:
    """(path, type) of every field in the schema of a record, at any depth.

    ``a.b`` is a field of an object, ``a[]`` the elements of an array.  A name with a dot
    or brackets stands in backticks.
    """
    found: list[tuple[str, str]] = []

    def name(at: int) -> tuple[str, int]:
        if shape[at] != "`":
            end = shape.index(":", at)
            return shape[at:end], end
        end = at + 1
        while shape[end] != "`" or shape[end + 1 : end + 2] == "`":
            end += 2 if shape[end] == "`" else 1
        own = shape[at + 1 : end].replace("``", "`")
        return (f"`{own}`" if any(c in own for c in ".[]`") else own), end + 1

    def kind(at: int, path: str) -> int:
        """Reads the type at ``at`` and the fields below ``path``; returns where it ends."""
        if shape.startswith("OBJECT<", at):
            at += 7
            while shape[at] != ">":
                field, at = name(at)
                below = f"{path}.{field}" if path else field
                start, place = at + 2, len(found)
                found.append((below, ""))
                at = kind(start, below)
                found[place] = (below, shape[start:at])
                if shape.startswith(", ", at):
                    at += 2
            return at + 1
        if shape.startswith("ARRAY<", at):
            start, place = at + 6, len(found)
            found.append((f"{path}[]", ""))
            at = kind(start, f"{path}[]")
            found[place] = (f"{path}[]", shape[start:at])
            return at + 1
        depth = 0
        while at < len(shape) and (depth or shape[at] not in ",>"):
            depth += {"(": 1, ")": -1}.get(shape[at], 0)
            at += 1
        return at

    kind(0, "")
    return found


def _taken_apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for file, shape, n in zip(b["source_file"], b["shape"], b["n"], strict=True):
            # a path that occurs twice in a shape (elements of nested arrays) is one
            per = [(CORRUPT, "STRING")] if shape is None else sorted(set(paths_of(shape)))
            rows += [(file, path, type_, n) for path, type_ in per]
        yield pd.DataFrame(rows, columns=["source_file", "column", "type", "n"])


def drift_of_lines(lines: DataFrame) -> DataFrame:
    """``(source_file, column, types, n_lines, n_file_lines, in_every_file)`` from ``(source_file, value)``.

    ``column`` is a path, ``types`` lists the JSON types that it has in that file.  Malformed
    lines are reported under the column name ``_corrupt_record``; blank lines are skipped.
    """
    shape = F.expr("schema_of_variant(try_parse_json(value))").alias("shape")
    ensure_checkpoint_dir(lines.sparkSession)
    shapes = lines.filter(F.trim("value") != "").groupBy("source_file", shape).agg(F.count(F.lit(1)).alias("n"))
    shapes = shapes.checkpoint()  # files x shapes rows; the lines are parsed once
    files = shapes.groupBy("source_file").agg(F.sum("n").alias("n_file_lines"))
    per_type = shapes.mapInPandas(_taken_apart, "source_file string, column string, type string, n long")
    columns = per_type.groupBy("source_file", "column").agg(
        F.sum("n").alias("n_lines"), F.array_join(F.sort_array(F.collect_set("type")), " | ").alias("types")
    )
    n_files = files.select(F.count("*")).scalar()
    spread = columns.groupBy("column").agg((F.count("*") == n_files).alias("in_every_file"))
    return (
        columns.join(files, "source_file")
        .join(spread, "column")
        .select("source_file", "column", "types", "n_lines", "n_file_lines", "in_every_file")
    )
