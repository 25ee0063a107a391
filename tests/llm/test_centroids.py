"""Centroid clustering: bounds, rounds against brute force, SQL, and awkward vectors."""

import hashlib
import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pedalflow.llm import centroids as C
from pedalflow.llm import oracle, registry

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=8, rounds=10, dims=64):
    """(vec_id, cluster, distance) by Python integers, and the centroids."""
    kept = [(i, [math.floor(1024 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) and abs(c) < 131072 for c in v)]
    name = lambda r: ("~" if r[0] is None else hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    means = [v for _, v in sorted(kept, key=name)[:k]]
    dist = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    for turn in range(rounds + 1):
        at = [min((dist(v, m), j) for j, m in enumerate(means)) for _, v in kept]
        if turn < rounds:
            for j in range(len(means)):
                own = [v for (_, v), (_, c) in zip(kept, at, strict=True) if c == j]
                if own:
                    means[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return sorted(((i, c, d) for (i, _), (d, c) in zip(kept, at, strict=True)), key=repr), means


def vectors(n, dims=64, groups=5, seed=1):
    r = random.Random(seed)
    middles = [[r.gauss(0, 0.2) for _ in range(dims)] for _ in range(groups)]
    return [(i, [float(np.float32(m + r.gauss(0, 0.05))) for m in r.choice(middles)]) for i in range(n)]


def test_bounds_never_exceed_the_distance_and_spare_most_of_them():
    r = np.random.default_rng(2)
    middles = r.normal(0, 300, (8, 64))
    x = np.floor(middles[r.integers(0, 8, 2000)] + r.normal(0, 60, (2000, 64))).astype(np.int64)
    pivots, means = x[:8], np.floor(middles).astype(np.int64)
    far = np.sqrt(C.squared(x[:, None], pivots[None]).astype(float))
    to = np.sqrt(C.squared(pivots[:, None], means[None]).astype(float))
    exact = C.squared(x[:, None], means[None])
    assert (C.pair_bounds(far, to, pivots) <= exact).all()
    at, best, measured = C.nearest(x, far, means, pivots)
    assert (at == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert measured < exact.size / 2


def test_equal_distances_go_to_the_smaller_number():
    pivots = np.array([[10, 0], [-10, 0], [10, 0]], np.int64)
    x = np.array([[0, 0], [10, 0], [0, 7]], np.int64)
    far = np.sqrt(C.squared(x[:, None], pivots[None]).astype(float))
    at, best, _ = C.nearest(x, far, pivots, pivots)
    assert at.tolist() == [0, 0, 0] and best.tolist() == [100, 0, 149]


@pytest.mark.parametrize("parts", [1, 7])
def test_against_brute_force(spark, parts):
    rows = vectors(150) + [(3, vectors(150)[3][1]), (None, [0.25] * 64), (500, [-0.0001] * 64)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(parts)
    want, means = brute(rows)
    found = C.cluster(df)
    assert found.centroids == means
    assert sorted(map(tuple, found.assigned.collect()), key=repr) == want


def test_vectors_that_are_left_out(spark):
    fine = vectors(20)
    odd = [(100, None), (101, []), (102, [0.1] * 63), (103, [0.1] * 63 + [None]), (104, [float("nan")] + [0.0] * 63),
           (105, [float("-inf")] + [0.0] * 63), (106, [3e38] * 64), (107, [131072.0] + [0.0] * 63)]
    df = spark.createDataFrame([(i, v, 0) for i, v in fine + odd], SCHEMA)
    df = df.select("*", *[F.lit("x").alias(c) for c in ("x", "far", "cluster", "Embedding", "distance")])
    rows = C.digest(df).collect()
    want, means = brute(fine)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in rows), key=repr) == want
    per = {c: sum(d for _, k, d in want if k == c) for _, c, _ in want}
    for r in rows:
        assert r["cluster_inertia"] == per[r["cluster"]] and r["inertia"] == sum(per.values())
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, means[r["cluster"]])).encode()).hexdigest()


def test_few_equal_or_no_vectors(spark):
    same = [(i, [0.5] * 64) for i in range(3)]
    df = spark.createDataFrame([(i, v, 0) for i, v in same], SCHEMA)
    assert sorted(map(tuple, C.cluster(df).assigned.collect())) == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]
    assert C.digest(df.limit(0)).collect() == []
    assert C.digest(df.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_DIR}/embeddings.parquet')")
    res = con.execute(oracle.oracle_sql()["op11_centroid_clustering"])
    names = [d[0] for d in res.description]
    df = registry.queries()["op11_centroid_clustering"](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(res.fetchall())
