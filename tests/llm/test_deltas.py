"""Pairs by differences from a pivot against all pairs."""

import random

import pytest

from pedalflow.llm import deltas, jaccard
from pedalflow.llm.common import Scratch


def family(r, size, members, edits, shared=()):
    """A base set and members with some elements taken out and others put in; some edits many members have."""
    base = r.sample(range(10**6), size)
    sets = [set(base)]
    for _ in range(members):
        s = set(base)
        for _ in range(r.randrange(edits + 1)):
            s.discard(r.choice(base))
            s.add(r.randrange(10**6, 2 * 10**6))
        s |= set(r.sample(shared, min(len(shared), r.randrange(4)))) if shared else set()
        sets.append(s)
    return sets


def linked(x, y, pct):
    return 100 * len(x & y) >= pct * len(x | y)


@pytest.mark.parametrize("pct, seed", [(80, 1), (90, 2), (50, 3), (90, 4)])
def test_every_link_of_a_group_is_found(spark, pct, seed):
    r = random.Random(seed)
    groups = [family(r, 40, 60, 6), family(r, 25, 40, 4, shared=list(range(5 * 10**6, 5 * 10**6 + 6))),
              [set(r.sample(range(60), r.randrange(1, 50))) for _ in range(40)]]
    rows, want = [], set()
    for g, sets in enumerate(groups):
        name = lambda i: 1000 * g + i  # noqa: B023, E731
        p = sets[0]
        rows += [(name(0), name(i), len(p), len(z), sorted(p ^ z)) for i, z in enumerate(sets) if i]
        far = [i for i, z in enumerate(sets) if i and not linked(p, z, pct)]
        want |= {(min(name(i), name(j)), max(name(i), name(j))) for i in far for j in range(1, len(sets)) if i != j and linked(sets[i], sets[j], pct)}
    work = Scratch(spark, "test")
    d = work.saved(spark.createDataFrame(rows, "p long, z long, n_p long, n_z long, delta array<long>"), "deltas")
    close = [(z, p) for p, z, n_p, n_z, e in rows if len(e) * (100 + pct) <= (100 - pct) * (n_p + n_z)]
    comps = spark.createDataFrame(close + [(p, p) for _, p in close], "id long, comp long").distinct()
    found = {tuple(x) for x in deltas.links(d, comps, pct, work).collect()}
    work.remove()
    known = dict(close)
    same = lambda a, b: known.get(a, a) == known.get(b, b)
    assert {x for x in found if not same(*x)} == {x for x in want if not same(*x)} and want


@pytest.mark.parametrize("few", [1, 2, 8])
def test_components_do_not_depend_on_what_is_paired(spark, few):
    """A large family whose members are mostly too far from each other, chains, and loose sets, all under one key."""
    r = random.Random(9)
    sets = family(r, 40, 50, 5) + family(r, 30, 30, 3)
    chain = set(range(7 * 10**6, 7 * 10**6 + 40))
    for i in range(12):
        chain = set(sorted(chain)[1:]) | {8 * 10**6 + i}
        sets.append(chain)
    # ids as the operator gives them play no part here; every set has the common key and one of its own
    rows = spark.createDataFrame([(k, i) for i in range(len(sets)) for k in (0, 10 + i // 7, 1000 + i)], "key long, id long")
    grams = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, grams array<long>")
    comps = jaccard.linked(rows, lambda ids, work: work.saved(grams.join(ids, "id", "left_semi"), "grams"), 90, few=few)
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j], 90):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    want = {i: root(i) for i in range(len(sets))}
    got = {x["id"]: x["comp"] for x in comps.collect()}
    assert {i: got.get(i, i) for i in want} == want and len(set(want.values())) < len(sets) - 12


def test_no_pairs_of_a_family_meet_by_what_its_pivot_alone_lacks(spark):
    """Members with three edits of their own, around a pivot with other edits: all lack the pivot's elements."""
    size, members = 120, 150
    base = list(range(size))
    far = [set(base) - set(range(3 * i % 100, 3 * i % 100 + 3)) | {10**6 + 10 * i + j for j in range(9)} for i in range(members)]
    pivot = set(base) - set(range(110, 119)) | set(range(10**7, 10**7 + 9))
    sets = [pivot, set(base), *far]
    rows = [(0, i, len(pivot), len(z), sorted(pivot ^ z)) for i, z in enumerate(sets) if i]
    work = Scratch(spark, "test")
    d = work.saved(spark.createDataFrame(rows, "p long, z long, n_p long, n_z long, delta array<long>"), "deltas")
    moved = deltas.recentred(d, work)
    got = {r["z"]: (r["p"], r["n_p"], r["n_z"], set(r["delta"])) for r in moved.collect()}
    # the base is the new pivot, the old one a member like others
    assert got == {i: (1, size, len(z), set(base) ^ z) for i, z in enumerate(sets) if i != 1}
    met = []
    for each in (d, moved):
        # the product's entries: elements by which sets could still meet
        inner = Scratch(spark, "inner")
        deltas.links(each, spark.createDataFrame([], "id long, comp long"), 90, inner)
        met.append(spark.read.parquet(f"{inner.dir}/*-entries").count())
        inner.remove()
    near = deltas.close_to_pivot(moved, 90).count()
    work.remove()
    assert met[1] * 5 < met[0]
    assert near == sum(linked(set(base), z, 90) for i, z in enumerate(sets) if i != 1)


def test_groups_with_the_same_centre_are_merged(spark):
    base = set(range(50))
    sets = {i: base | {100 + i} for i in range(1, 30)} | {0: base}
    rows = [(p, z, len(sets[p]), len(s), sorted(sets[p] ^ s)) for p in (1, 2) for z, s in sets.items() if z != p and (z + p) % 3]
    rows += [(2, 0, 51, 50, [102])] if not any(r[:2] == (2, 0) for r in rows) else []
    rows += [(1, 0, 51, 50, [101])] if not any(r[:2] == (1, 0) for r in rows) else []
    work = Scratch(spark, "test")
    d = work.saved(spark.createDataFrame(rows, "p long, z long, n_p long, n_z long, delta array<long>"), "deltas")
    got = [(r["p"], r["z"], set(r["delta"])) for r in deltas.recentred(d, work).collect()]
    work.remove()
    want = {z for _, z, *_ in rows} | {1, 2}
    assert sorted(got, key=lambda r: r[1]) == [(0, z, {100 + z}) for z in sorted(want - {0})]


@pytest.mark.parametrize("seed, most", [(1, 2), (2, 4), (3, 6), (4, 12)])
def test_pairs_within_a_fixed_distance(spark, seed, most):
    """What is near in content and size is met, or both sets are within the limit of the pivot."""
    r = random.Random(seed)
    sets = family(r, 30, 80, 6) + [set(range(20)) - set(r.sample(range(20), r.randrange(8))) for _ in range(40)]
    p, limit = sets[0], lambda n: n * 0 + most - (n % 2)
    rows = [(0, i, len(p), len(z), sorted(p ^ z)) for i, z in enumerate(sets) if i]
    work = Scratch(spark, "test")
    d = work.saved(spark.createDataFrame(rows, "p long, z long, n_p long, n_z long, delta array<long>"), "deltas")
    comps = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id long, comp long")
    met, inner = deltas.within(d, comps, limit, work)
    found, inside = {tuple(x) for x in met.collect()}, {x["z"] for x in inner.collect()}
    work.remove()
    want = {
        (i, j) for j in range(1, len(sets)) for i in range(1, j)
        if len(sets[i] ^ sets[j]) + abs(len(sets[i]) - len(sets[j])) <= min(limit(len(sets[i])), limit(len(sets[j]))) and j > 3
    }
    assert want and all(x in found or set(x) <= inside for x in want)
    # and little else, of all that share an element of their differences
    assert len(found) < len(want) + 40
