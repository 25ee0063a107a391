"""Top-n and deterministic picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows in ``order`` (add key columns to ``order`` for a stable tie-break).

    Planned as a per-partition top-n followed by a merge of n rows per task,
    never a full sort.
    """
    return df.orderBy(*order).limit(n)


def pick_one(df: DataFrame, col: str, seed: int = 0) -> DataFrame:
    """One value of ``col`` chosen by a seeded hash -- the smallest MD5 of value and
    seed -- so the answer is the same on every run and partition layout (F4)."""
    key = F.md5(F.concat(F.col(col).cast("string"), F.lit(str(seed))))
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(key, col).limit(1)
