"""Centroid clustering with Ptolemaic pivots.

Vectors become integers once, so sums, means (rounded down) and squared distances are
exact and the result does not depend on partitions or order.  The first centroids are
the ``k`` vectors with the smallest hash of their ids; they also serve as the fixed
pivots.  Every vector's distances to the pivots are computed once and kept in a table
in the shared folder, which each round reads again.

For a centroid c, a vector x and a pivot pair (s, t), Ptolemy's inequality gives

    d(x, c) >= |d(x, s) d(c, t) - d(x, t) d(c, s)| / d(s, t)

from cached distances only.  The bound is rounded down by more than the arithmetic can
err, the centroid of the smallest bound is measured first, and only centroids whose
bound does not exceed that distance are measured exactly as well; a tie goes to the
smaller number.  A round is one pass over the table: each task adds up its members per
centroid, and k rows of sums come to the driver.

Defined cases: vectors that are null, of another length, or hold a null, NaN, an
infinity or a component of 131072 or more (whose squared distances fit no long) are
left out; repeated rows count each; a row without id is a member like others, but seeds
come first from rows with one; rows of one id are ordered by their components.  Fewer
vectors than ``k`` give fewer centroids, none an empty result.  A centroid without
members stays where it is.  Extra columns, whatever their names, are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_arrow, pick, saved

DIMS, SCALE, K, ROUNDS, SALT = 64, 1024, 8, 10, "3:"
#: Components of this size or more, before scaling, have no exact distances in a long.
TOO_LARGE = 131072.0
#: Far more than the relative rounding error of a bound (a few units of 2^-53).
SLACK = 2.0**-40
#: Vectors measured at once.
STEP = 4096


@dataclass
class Clustering:
    """Final centroids (integers), ``assigned``: vec_id, cluster, distance of every vector, saved."""

    centroids: list[list[int]]
    assigned: DataFrame


def whole_numbers(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id, x: floor(scale * component) of every vector of ``dims`` finite components."""
    d = pick(vectors, "vec_id", "embedding").withColumn("v", F.col("embedding").cast("array<double>"))

    def fine(x: Column) -> Column:
        return F.coalesce(F.abs(x) < TOO_LARGE, F.lit(False))  # null and NaN compare to no truth

    x = F.transform("v", lambda c: F.when(fine(c), F.floor(scale * c)).cast("int"))
    return d.filter((F.size("v") == dims) & F.forall("v", fine)).select("vec_id", x.alias("x"))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exact."""
    d = x - y
    return (d * d).sum(-1)


def pair_bounds(far: np.ndarray, to: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Lower bounds of squared distances, rows x centroids.

    ``far`` holds distances of rows to pivots, ``to`` those of pivots to centroids.
    """
    low = np.zeros((len(far), to.shape[1]))
    for s in range(len(pivots)):
        for t in range(s):
            apart = np.sqrt(float(squared(pivots[s], pivots[t])))
            if apart:
                a, b = far[:, s, None] * to[t], far[:, t, None] * to[s]
                np.maximum(low, (np.abs(a - b) - (a + b) * SLACK) / (apart * (1 + SLACK)), out=low)
    return low * low * (1 - SLACK)


def nearest(x: np.ndarray, far: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each row's nearest centroid, its squared distance, and how many distances were measured in all."""
    to = np.sqrt(squared(pivots[:, None], centroids[None]).astype(float))
    low = pair_bounds(far, to, pivots)
    at = low.argmin(1)
    first = at.copy()
    best = squared(x, centroids[at])
    measured = len(x)
    for j in range(len(centroids)):
        open_ = np.flatnonzero((first != j) & (low[:, j] <= best * (1 + SLACK)))
        measured += len(open_)
        d = squared(x[open_], centroids[j])
        wins = (d < best[open_]) | (d == best[open_]) & (j < at[open_])
        at[open_[wins]], best[open_[wins]] = j, d[wins]
    return at, best, measured


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, pivots: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, STEP):
            b = whole.slice(at, STEP)
            x = b["x"].flatten().to_numpy().astype(np.int64).reshape(-1, dims)
            yield b["vec_id"], x, b["far"].flatten().to_numpy().reshape(-1, pivots)


def _with_pivots(whole: DataFrame, pivots: np.ndarray, kind: str) -> DataFrame:
    """``whole`` with ``far``, the distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for all_ in batches:
            for at in range(0, all_.num_rows, STEP):
                b = all_.slice(at, STEP)
                x = b["x"].flatten().to_numpy().astype(np.int64).reshape(-1, pivots.shape[1])
                far = np.sqrt(np.stack([squared(x, p) for p in pivots], 1).astype(float))
                ends = pa.array(np.arange(len(x) + 1) * len(pivots), pa.int32())
                far = pa.ListArray.from_arrays(ends, pa.array(far.ravel()))
                yield pa.RecordBatch.from_arrays([b["vec_id"], b["x"], far], names=["vec_id", "x", "far"])

    return map_arrow(whole, run, f"vec_id {kind}, x array<int>, far array<double>")


def _sums(cached: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> list:
    """cluster, total (per component) and n of the clusters that have members; at most k rows."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x, far in _blocks(batches, dims, len(pivots)):
            at = nearest(x, far, centroids, pivots)[0]
            for j in range(k):
                own = x[at == j]
                totals[j] += own.sum(0)
                counts[j] += len(own)
        own = np.flatnonzero(counts)
        columns = [own.repeat(dims), np.tile(np.arange(dims), len(own)), totals[own].ravel(), counts[own].repeat(dims)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cluster", "dim", "total", "n"])

    found = map_arrow(cached, run, "cluster long, dim long, total long, n long")
    wide = found.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    by_dim = F.array_sort(F.collect_list(F.struct("dim", "total")))
    return wide.groupBy("cluster").agg(F.transform(by_dim, lambda c: c["total"]).alias("total"), F.min("n").alias("n")).collect()


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, salt: str = SALT
) -> Clustering:
    """``rounds`` rounds of assignment and means from the ``k`` seeds, then one more assignment."""
    spark = vectors.sparkSession
    whole = whole_numbers(vectors, dims, scale)
    kind = whole.schema["vec_id"].dataType.simpleString()
    name = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    seeds = whole.orderBy(name.asc_nulls_last(), "vec_id", "x").limit(k).collect()  # k rows
    out = f"vec_id {kind}, cluster int, distance long"
    if not seeds:
        return Clustering([], spark.createDataFrame([], out))
    pivots = np.array([r["x"] for r in seeds], np.int64)
    centroids = pivots.copy()
    work = Scratch(spark, "centroids")
    cached = work.saved(_with_pivots(whole, pivots, kind), "cached")
    for _ in range(rounds):
        for r in _sums(cached, centroids, pivots):
            centroids[r["cluster"]] = [int(t) // r["n"] for t in r["total"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, far in _blocks(batches, dims, len(pivots)):
            at, d, _ = nearest(x, far, centroids, pivots)
            yield pa.RecordBatch.from_arrays([ids, pa.array(at, pa.int32()), pa.array(d)], names=["vec_id", "cluster", "distance"])

    assigned = saved(map_arrow(cached, run, out), "assigned")
    work.remove()
    return Clustering(centroids.tolist(), assigned)


def digest(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector."""
    found = cluster(vectors)
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = found.assigned.groupBy("cluster").agg(total.alias("total")).collect()  # k rows at most
    rows = []
    for r in per:
        name = hashlib.sha256(",".join(map(str, found.centroids[r["cluster"]])).encode()).hexdigest()
        rows.append((r["cluster"], int(r["total"]), int(sum(p["total"] for p in per)), name))
    of = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return found.assigned.join(F.broadcast(of), "cluster").select(*columns)  # k rows
