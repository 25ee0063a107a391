"""Station clustering (L21, K1-K3): k-means and silhouettes that can be proved.

Features are standardised (zero mean, unit variance) and put on a grid of whole
numbers, so every sum is exact and the groups depend on neither partitions nor order:

* the first centre is the station whose hash with ``seed`` is smallest, each further one the
  station farthest from all centres so far (ties by station), so the seeds of k centres are
  the first k of any larger k;
* a step assigns every station to its nearest centre (ties: the smaller number) and moves
  the centres to their members' means, rounded down; centres without members stay.

All values of k are stepped together: one pass and one aggregate a step, of a row per (k,
group).  The silhouette (squared Euclidean) needs only the same sums per group, so the
scores of all k take one more aggregate for the sums and one for the means.  What comes
to the driver are centres and sums, at most the sum of all k rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .data import TripData
from .flows import od_weekday_counts

#: Raw coordinates are read in steps of 1 / UNIT, standardised ones in steps of 1 / GRID.
UNIT, GRID = 1_000_000, 1_000_000
STEPS = 20
Centre = tuple[int, ...]


def station_points(data: TripData) -> DataFrame:
    """One point per station number: mean coordinate of its station rows."""
    return (
        data.stations.filter(F.col("station").isNotNull())
        .groupBy("station")
        .agg(F.avg("lat").alias("x"), F.avg("lon").alias("y"))
    )


def _standardised(points: DataFrame, features: Sequence[str]) -> DataFrame:
    clean = points.dropna(subset=list(features))  # the others are a group of their own
    vec = VectorAssembler(inputCols=list(features), outputCol="features").transform(clean)
    scaler = StandardScaler(inputCol="features", outputCol="standardized", withMean=True, withStd=True)
    return scaler.fit(vec).transform(vec)


#: Group of the stations that cannot be placed: a coordinate is unknown.
NO_COORDINATES = -1


def standardised_points(points: DataFrame, features: Sequence[str] = ("x", "y")) -> DataFrame:
    """The features that the clustering sees: ``(x - mean) / sample stddev`` per column."""
    scaled = _standardised(points, features)
    z = vector_to_array("standardized")
    return scaled.select("station", *[z[i].alias(f"{f}_std") for i, f in enumerate(features)])


def grid_points(points: DataFrame, features: Sequence[str] = ("x", "y"), unit: int = UNIT) -> DataFrame:
    """``(station, z0, z1, ...)``: standardised features as whole numbers, checkpointed.

    Dealt out by station first: a list of points is a small file, which one task would read in every pass.
    """
    ensure_checkpoint_dir(points.sparkSession)
    names = [f"z{i}" for i in range(len(features))]
    raw = points.dropna(subset=list(features)).select(
        "station", *[F.round(F.col(f) * unit).cast("long").alias(z) for f, z in zip(features, names, strict=True)]
    )
    exact = [F.col(z).cast("decimal(38,0)") for z in names]
    sums = raw.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(exact)],
                   *[F.sum((F.col(z) * F.col(z)).cast("decimal(38,0)")).alias(f"q{i}") for i, z in enumerate(names)]).first()
    n, cols = sums["n"], []
    for i, z in enumerate(names):
        s, q = float(sums[f"s{i}"] or 0), float(sums[f"q{i}"] or 0)
        spread = math.sqrt((q - s * s / n) / (n - 1)) if n > 1 else 0.0
        cols.append(F.floor(GRID * ((F.col(z) - s / n) / spread)).alias(z) if spread else F.lit(0).cast("long").alias(z))
    return raw.select("station", *cols).repartition("station").checkpoint()


def _squared(names: Sequence[str], centre: Centre) -> Column:
    total = F.lit(0).cast("long")
    for z, c in zip(names, centre, strict=True):
        total = total + (F.col(z) - c) * (F.col(z) - c)
    return total


def _nearest(names: Sequence[str], centres: Sequence[Centre]) -> Column:
    """Number of the nearest centre, the smaller of equals."""
    each = [F.struct(_squared(names, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    return F.array_min(F.array(*each))["i"]


def farthest_points(grid: DataFrame, k: int, seed: int = 1) -> list[Centre]:
    """``k`` stations far from each other (fewer if there are fewer places): one pass and one row each."""
    names = [c for c in grid.columns if c != "station"]
    name = F.md5(F.concat(F.col("station").cast("string"), F.lit(str(seed))))
    found = [tuple(r[z] for z in names) for r in grid.orderBy(name, "station").limit(1).collect()]
    while found and len(found) < k:
        away = F.array_min(F.array(*[_squared(names, c) for c in found])).alias("away")
        far = grid.select("*", away).orderBy(F.desc("away"), "station").limit(1).first()
        if far["away"] == 0:
            break
        found.append(tuple(far[z] for z in names))
    return found


def _assign(names: Sequence[str], centres: dict[int, list[Centre]]):
    """A function of an Arrow batch: its features as columns of whole numbers, and the nearest centre of every row by k.

    Whole numbers stay exact: 64 bits where all squares fit, Python's integers elsewhere.
    Sent to the workers by value, so it holds nothing of this module.
    """
    reach = max((abs(x) for of_k in centres.values() for c in of_k for x in c), default=0)

    def run(batch):
        import numpy as np

        z = [batch.column(batch.schema.get_field_index(f)).to_numpy(zero_copy_only=False) for f in names]
        most = max((max(abs(int(c.min())), abs(int(c.max()))) for c in z), default=0) + reach
        if len(names) * most * most >= 1 << 62:
            z = [c.astype(object) for c in z]
        nearest = {}
        for k, of_k in centres.items():
            best, at = None, np.zeros(len(z[0]), np.int64)
            for i, centre in enumerate(of_k):
                d = sum((c - x) * (c - x) for c, x in zip(z, centre, strict=True))
                if best is None:
                    best = d
                    continue
                closer = (d < best).astype(bool)  # of equals the smaller number stays
                best, at = np.where(closer, d, best), np.where(closer, i, at)
            nearest[k] = at
        return z, nearest

    return run


def _sums(grid: DataFrame, names: Sequence[str], centres: dict[int, list[Centre]]) -> dict[tuple[int, int], list[int]]:
    """Members, sums and sum of squares of every (k, group) that has members, in one aggregate.

    A task adds up its rows and hands on a row per (k, group).
    """
    assign, fields = _assign(names, centres), ("n", *names, "square")

    def run(batches):
        from decimal import Decimal

        import numpy as np
        import pyarrow as pa

        def total(values) -> int:
            if values.dtype == object:
                return int(values.sum())
            # halves of 32 bits, so that their sums fit
            return (int((values >> 32).sum()) << 32) + int((values & 0xFFFFFFFF).sum())

        held: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z, nearest = assign(batch)
            square = sum(c * c for c in z)
            for k, at in nearest.items():
                order = np.argsort(at, kind="stable")
                edges = np.searchsorted(at[order], np.arange(len(centres[k]) + 1))
                by_group = [c[order] for c in (*z, square)]
                for i in range(len(centres[k])):
                    low, high = int(edges[i]), int(edges[i + 1])
                    if low < high:
                        new = [high - low, *[total(c[low:high]) for c in by_group]]
                        old = held.get((k, i))
                        held[k, i] = new if old is None else [x + y for x, y in zip(old, new, strict=True)]
        if held:
            columns = [pa.array([k for k, _ in held], pa.int32()), pa.array([c for _, c in held], pa.int32())]
            for j in range(len(fields)):
                columns.append(pa.array([Decimal(v[j]) for v in held.values()], pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays(columns, names=["k", "c", *fields])

    schema = ", ".join(["k int", "c int", *[f"{f} decimal(38,0)" for f in fields]])
    per = grid.select(*names).mapInArrow(run, schema).groupBy("k", "c").agg(*[F.sum(f).alias(f) for f in fields])
    return {(r["k"], r["c"]): [int(r[x]) for x in fields] for r in per.collect()}


def centres_by_k(grid: DataFrame, ks: Sequence[int], seed: int = 1, steps: int = STEPS) -> dict[int, list[Centre]]:
    """The centres of each k after ``steps`` steps, or as soon as none moves any more."""
    names = [c for c in grid.columns if c != "station"]
    seeds = farthest_points(grid, max(ks), seed)
    centres = {int(k): seeds[: int(k)] for k in ks}
    for _ in range(steps if seeds else 0):
        sums = _sums(grid, names, centres)
        moved = {
            k: [tuple(s // sums[k, i][0] for s in sums[k, i][1:-1]) if (k, i) in sums else c for i, c in enumerate(own)]
            for k, own in centres.items()
        }
        if moved == centres:
            break
        centres = moved
    return centres


def station_clusters(
    points: DataFrame, k: int = 4, seed: int = 1, features: Sequence[str] = ("x", "y"), unit: int = UNIT, steps: int = STEPS
) -> DataFrame:
    """``(station, cluster)`` from k-means on standardised features (K1).  Stations without
    coordinates are kept as a group of their own, ``NO_COORDINATES``."""
    unplaced = F.lit(False)
    for f in features:
        unplaced = unplaced | F.col(f).isNull() | F.isnan(f)
    rest = points.filter(unplaced).select("station", F.lit(NO_COORDINATES).alias("cluster"))
    grid = grid_points(points, features, unit)
    centres = centres_by_k(grid, [k], seed, steps)[k]
    if not centres:
        return rest
    names = [c for c in grid.columns if c != "station"]
    return grid.select("station", _nearest(names, centres).alias("cluster")).union(rest)


def silhouette_of(points: DataFrame, group: str, features: Sequence[str] = ("x", "y")) -> DataFrame:
    """``(silhouette)`` of a given grouping (an int column of ``points``) over the standardised features."""
    evaluator = ClusteringEvaluator(
        predictionCol=group, featuresCol="standardized", metricName="silhouette", distanceMeasure="squaredEuclidean"
    )
    scaled = _standardised(points.filter(F.col(group).isNotNull()), features)
    return points.sparkSession.createDataFrame([(float(evaluator.evaluate(scaled)),)], "silhouette double")


def silhouette_by_k(
    points: DataFrame,
    ks: Sequence[int] = range(2, 10),
    seed: int = 1,
    features: Sequence[str] = ("x", "y"),
    unit: int = UNIT,
    steps: int = STEPS,
) -> DataFrame:
    """``(k, silhouette)`` for each k (K2), the mean over all stations.

    With n members, sums s and sum of squares q of a group, a point's mean squared distance
    to it is p.p + q / n - 2 p.s / n; in its own group the mean is over the n - 1 others.
    A station alone in its group scores 0; k without two groups has no score.
    """
    grid = grid_points(points, features, unit)
    names = [c for c in grid.columns if c != "station"]
    centres = centres_by_k(grid, ks, seed, steps)
    sums = _sums(grid, names, centres)
    groups = {k: [(i, *sums[k, i]) for i in range(len(of_k)) if (k, i) in sums] for k, of_k in centres.items()}
    scored = {k: g for k, g in groups.items() if len(g) > 1}
    rows: list[tuple[int, float | None]] = [(k, None) for k in centres if k not in scored]
    if scored:
        total = _scores(grid, names, {k: centres[k] for k in scored}, scored)
        rows += [(k, total[k] / 1e9 / sum(n for _, n, *_ in g)) for k, g in scored.items()]
    return points.sparkSession.createDataFrame(sorted(rows), "k int, silhouette double")


def _scores(
    grid: DataFrame, names: Sequence[str], centres: dict[int, list[Centre]], groups: dict[int, list[tuple[int, ...]]]
) -> dict[int, int]:
    """The sum of all silhouettes of each k, in whole multiples of 1e-9, so that the order of the sum does not matter."""
    assign = _assign(names, centres)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = dict.fromkeys(groups, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            z, nearest = assign(batch)
            z = [c.astype(np.float64) for c in z]
            own = sum(c * c for c in z)
            for k, of_k in groups.items():
                at = nearest[k]
                a, b = np.full(len(at), np.nan), np.full(len(at), np.inf)
                for i, n, *s, q in of_k:
                    mean = own + float(q) / n - 2 * sum(c * float(x) for c, x in zip(z, s, strict=True)) / n
                    inside = at == i
                    if n > 1:
                        a = np.where(inside, mean * n / (n - 1), a)
                    b = np.where(inside, b, np.minimum(b, mean))
                score = np.zeros(len(at))
                np.divide(a, b, out=score, where=a < b)
                score = np.where(a < b, 1 - score, score)
                over = a > b  # a station alone in its group has no a and scores 0
                score[over] = b[over] / a[over] - 1
                held[k] += int(np.floor(score * 1e9).astype(np.int64).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.int64())], names=["k", "score"])

    per = grid.select(*names).mapInArrow(run, "k int, score long").groupBy("k").agg(F.sum("score").alias("score"))
    return {r["k"]: r["score"] for r in per.collect()}


def cluster_od_counts(data: TripData, clusters: DataFrame) -> DataFrame:
    """Trips per (start station group, end station group, weekday) (K3).

    Trips are counted per station pair and weekday first (D5, combined map-side), so the
    group lookups join those counts, not trips.
    """
    groups = clusters.select("station", "cluster")
    o = groups.select(F.col("station").alias("unplug_station"), F.col("cluster").alias("origin_group"))
    d = groups.select(F.col("station").alias("plug_station"), F.col("cluster").alias("dest_group"))
    return (
        od_weekday_counts(data)
        .join(o, "unplug_station")
        .join(d, "plug_station")
        .groupBy("origin_group", "dest_group", "dayofweek")
        .agg(F.sum("n_trips").alias("n_trips"))
    )
