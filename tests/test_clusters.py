"""Clustering on points whose answer is known."""

from pyspark.sql import functions as F

from pedalflow.plans import clusters


def _points(spark):
    groups = [(0.0, 0.0), (10.0, 10.0), (0.0, 20.0)]
    rows = []
    for g, (x, y) in enumerate(groups):
        for i in range(6):
            rows.append((g * 100 + i, x + 0.1 * (i % 3), y + 0.1 * (i // 3)))
    return spark.createDataFrame(rows, "station long, x double, y double")


def test_kmeans_recovers_separated_groups(spark):
    pts = _points(spark)
    got = clusters.station_clusters(pts, k=3, seed=1)
    labels = got.withColumn("group", (F.col("station") / 100).cast("int"))
    # every true group maps to exactly one cluster and the three clusters differ
    per_group = labels.groupBy("group").agg(F.count_distinct("cluster").alias("n")).collect()
    assert all(r["n"] == 1 for r in per_group)
    assert labels.select("cluster").distinct().count() == 3


def test_silhouette_peaks_at_true_k(spark):
    scores = {r["k"]: r["silhouette"] for r in clusters.silhouette_by_k(_points(spark), ks=range(2, 6), seed=1).collect()}
    assert max(scores, key=scores.get) == 3
    assert scores[3] > 0.9


def test_cluster_od_counts_sum_to_zoned_trips(spark, data):
    pts = clusters.station_points(data)
    groups = clusters.station_clusters(pts, k=2, seed=1)
    od = clusters.cluster_od_counts(data, groups)
    # every station of the fixture has coordinates, so every trip with two known stations is counted
    known = data.trips.join(groups.select(F.col("station").alias("unplug_station")), "unplug_station").join(
        groups.select(F.col("station").alias("plug_station")), "plug_station")
    assert od.agg(F.sum("n_trips")).first()[0] == known.count()


def test_stations_without_coordinates_are_a_group_of_their_own(spark, data):
    pts = _points(spark).union(spark.createDataFrame([(900, None, 1.0), (901, 2.0, float("nan"))], "station long, x double, y double"))
    got = {r["station"]: r["cluster"] for r in clusters.station_clusters(pts, k=3, seed=1).collect()}
    assert got[900] == got[901] == clusters.NO_COORDINATES and len(got) == 20
    assert sorted(set(got.values())) == [-1, 0, 1, 2]


def _brute(rows, k, seed, steps, unit=1_000_000):
    """Groups by Python integers."""
    import hashlib
    import math

    cols = [[int(r[f + 1] * unit + 0.5) for r in rows] for f in range(2)]
    grid = []
    for c in cols:
        n, s, q = len(c), float(sum(c)), float(sum(x * x for x in c))
        spread = math.sqrt((q - s * s / n) / (n - 1))
        grid.append([math.floor(1_000_000 * ((x - s / n) / spread)) for x in c])
    pts = dict(zip([r[0] for r in rows], zip(*grid, strict=True), strict=True))
    away = lambda p, q: sum((a - b) ** 2 for a, b in zip(p, q, strict=True))
    centres = [pts[min(pts, key=lambda i: (hashlib.md5(f"{i}{seed}".encode()).hexdigest(), i))]]
    while len(centres) < k:
        centres.append(pts[min(pts, key=lambda i: (-min(away(pts[i], c) for c in centres), i))])
    for turn in range(steps + 1):
        at = {i: min(range(k), key=lambda j: (away(p, centres[j]), j)) for i, p in pts.items()}
        if turn < steps:
            for j in range(k):
                own = [pts[i] for i in pts if at[i] == j]
                if own:
                    centres[j] = tuple(sum(v) // len(own) for v in zip(*own, strict=True))
    return at


def test_groups_depend_on_neither_partitions_nor_order(spark):
    import random

    r = random.Random(3)
    rows = [(i, r.gauss(0, 3), r.gauss(5, 1)) for i in range(120)] + [(500 + i, 1.0, 2.0) for i in range(10)]
    rows = [(i, abs(x), abs(y)) for i, x, y in rows]
    want = _brute(rows, 5, 7, 6)
    for parts in (1, 8):
        r.shuffle(rows)
        pts = spark.createDataFrame(rows, "station long, x double, y double").repartition(parts)
        assert {p["station"]: p["cluster"] for p in clusters.station_clusters(pts, k=5, seed=7, steps=6).collect()} == want
        one = clusters.silhouette_by_k(pts, ks=[2, 5], seed=7).collect()
        assert [tuple(x) for x in one] == [tuple(x) for x in clusters.silhouette_by_k(pts.repartition(3), ks=[2, 5], seed=7).collect()]


def test_all_k_take_one_pass_a_step(spark, monkeypatch):
    passes = []
    sums = clusters._sums
    monkeypatch.setattr(clusters, "_sums", lambda grid, names, centres: passes.append(len(centres)) or sums(grid, names, centres))
    clusters.silhouette_by_k(_points(spark), ks=range(2, 10), steps=5)
    assert len(passes) <= 6 and set(passes) == {8}


def test_fewer_places_than_groups_and_no_points(spark):
    same = spark.createDataFrame([(i, 1.0, float(i % 2)) for i in range(6)], "station long, x double, y double")
    assert {r["cluster"] for r in clusters.station_clusters(same, k=4).collect()} == {0, 1}
    scores = {r["k"]: r["silhouette"] for r in clusters.silhouette_by_k(same, ks=[2, 4]).collect()}
    assert scores == {2: 1.0, 4: 1.0}
    none = same.filter("station < 0")
    assert clusters.station_clusters(none, k=3).collect() == []
    assert [tuple(r) for r in clusters.silhouette_by_k(same.limit(1), ks=[2]).collect()] == [(2, None)]


def test_points_of_one_small_file_are_dealt_out(spark, tmp_path):
    spark.range(400_000).selectExpr("id AS station", "id % 71 * 1.0 AS x", "id % 53 * 1.0 AS y").coalesce(1).write.parquet(str(tmp_path / "p"))
    grid = clusters.grid_points(spark.read.parquet(str(tmp_path / "p")))
    assert grid.rdd.getNumPartitions() > 1 and grid.count() == 400_000


def test_sums_are_exact_beyond_64_bits(spark):
    far = 3_000_000_000
    pts = [(i, (-1) ** i * (far + i), 7 - i) for i in range(9)] + [(100 + i, i % 2, 4) for i in range(5)]
    centres = {2: [(-far, 0), (far, 0)], 3: [(0, 4), (far, 1), (-far, -1)]}
    grid = spark.createDataFrame(pts, "station long, z0 long, z1 long").repartition(3)
    want = {}
    for k, own in centres.items():
        for _, x, y in pts:
            at = min(range(k), key=lambda j: ((x - own[j][0]) ** 2 + (y - own[j][1]) ** 2, j))
            old = want.get((k, at), [0, 0, 0, 0])
            want[k, at] = [a + b for a, b in zip(old, [1, x, y, x * x + y * y], strict=True)]
    assert clusters._sums(grid, ["z0", "z1"], centres) == want
