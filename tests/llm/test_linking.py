"""Components, and links in groups against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from pedalflow.llm import linking
from pedalflow.llm.common import Scratch


def roots(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    chain = [(i, i + 1) for i in range(0, 40)]
    pairs = chain + [(rnd.randint(100, 160), rnd.randint(100, 160)) for _ in range(40)] + [(200, 200)]
    rnd.shuffle(pairs)
    got = {r["id"]: r["comp"] for r in linking.components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {x: c for x, c in roots([p for p in pairs if p[0] != p[1]]).items()}


def test_no_edges(spark):
    assert linking.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def numbers(ids, work):
    """Ids are points on a line; close ones are at most five apart."""
    return lambda pairs: pairs.filter("abs(a - b) <= 5")


def halves(rows, turn):
    """Points at most five apart share one of two cuts into stretches of twelve."""
    cut = F.explode(F.array(F.floor((F.col("id") + turn) / 12) * 2, F.floor((F.col("id") + 6 + turn) / 12) * 2 + 1))
    return rows.select("key", "id", cut.alias("part")).select(F.xxhash64("key", "part").alias("key"), "id")


def pairs(large, comps, compare, work):
    return compare(work.saved(linking.open_pairs(large), "pairs"))


@pytest.mark.parametrize("seed, few, turns", [(1, 8, 2), (2, 1, 0), (3, 2, 1), (4, 100, 0)])
def test_links_join_what_all_pairs_join(spark, seed, few, turns):
    rnd = random.Random(seed)
    rows = [(k, rnd.randint(0, 400)) for k in range(6) for _ in range(rnd.choice([1, 2, 30, 60]))]
    rows += [(50, i * 100) for i in range(12)]  # far apart
    rows += [(51, i * 3) for i in range(40)]  # a chain
    found = linking.linked(spark.createDataFrame(rows + rows[:20], "key long, id long"), numbers, pairs, few, halves, turns)
    want = [(a, b) for k, a in set(rows) for q, b in set(rows) if k == q and a < b and b - a <= 5]
    got = {r["id"]: r["comp"] for r in found.collect()}
    # all that is close within a key is joined, and nothing that no close pairs join
    assert all(got[a] == got[b] for a, b in want)
    ids = {a for _, a in rows}
    close = roots([(a, b) for a in ids for b in ids if a < b and b - a <= 5])
    assert all(close[i] == close[c] for i, c in got.items())


def test_large_groups_are_never_paired_as_a_whole(spark):
    """A thousand points far from each other under one key: finer keys leave few of them together."""
    compared = []

    def prepare(ids, work):
        return lambda p: compared.append(p.count()) or p.filter("abs(a - b) <= 5")

    rows = spark.range(1000).selectExpr("7L AS key", "id * 9 AS id").union(spark.sql("SELECT 7L, 4L"))
    found = linking.linked(rows, prepare, pairs, 8, halves, 1)
    assert {tuple(r) for r in found.collect()} == {(0, 0), (4, 0), (9, 0)}
    assert sum(compared) < 5000


def test_no_shared_key(spark):
    assert linking.linked(spark.createDataFrame([(1, 1), (2, 2), (2, 2)], "key long, id long"), numbers, pairs) is None


def test_only_without_broadcast(spark, monkeypatch):
    df = spark.range(100).selectExpr("id % 10 key", "id")
    keys = spark.createDataFrame([(3,), (4,)], "key long")
    one = linking.only(df, keys, "key").count()
    monkeypatch.setattr(linking, "BROADCAST_ROWS", 0)
    assert linking.only(df, keys, "key").count() == one == 20
