"""N-gram Jaccard join against all pairs."""

import os
import random
import re

import numpy as np
import pytest
from awkward import ODD_ROWS, as_rows, clashing, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from pedalflow.llm import jaccard as J

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, pct):
    """(doc_id, size, component) by comparing every pair that shares a shingle."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    seen = {}
    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        shared = {}
        for g in s:
            for j in seen.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            seen[g].append(i)
        for j, both in shared.items():
            if 100 * both >= pct * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    first = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            first[r] = min(first.get(r, d), d)
    return sorted(((d, len(s), None if d is None else first[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 150), st.integers(0, 30), st.integers(0, 30), st.sampled_from([80, 90, 95, 100]), st.integers(0, 10**6))
def test_similar_sets_share_a_block(size, gone, added, pct, seed):
    rnd = np.random.default_rng(seed)
    x = np.unique(rnd.integers(0, 2**64, size, dtype=np.uint64))
    y = np.unique(np.concatenate([x[min(gone, len(x) - 1) :], rnd.integers(0, 2**64, added, dtype=np.uint64)]))
    both = len(np.intersect1d(x, y))
    cuts = J.Cuts(pct)
    if 100 * both >= pct * (len(x) + len(y) - both):
        assert np.intersect1d(J.block_keys(x, cuts), J.block_keys(y, cuts)).size
    assert J.overlap(x, y, both) == both and J.overlap(x, y, both + 1) is None


@pytest.mark.parametrize("pct", [80, 85, 90])
def test_hardly_any_set_has_more_empty_blocks_than_spare_ones(pct):
    """Such sets get a key for every block of each empty one: 13 keys an n-gram at 80 per cent once."""
    r = np.random.default_rng(pct)
    cuts = J.Cuts(pct)
    for size in (50, 130, 200, 400, 600, 990, 1000, 1600, 3000):
        sets = [np.unique(r.integers(0, 2**64, size, dtype=np.uint64)) for _ in range(100)]
        assert sum(len(J.block_keys(s, cuts)) for s in sets) < 1.5 * 100 * size


def test_long_texts_are_cut_at_words(monkeypatch):
    text = " ".join(random.Random(1).choices("a b c dd eee ff".split(), k=2000))
    whole = J.shingles(text, 3)
    monkeypatch.setattr(J, "STEP", 64)
    assert (J.shingles(text, 3) == whole).all() and len(whole) == len(shingles(text, 3))


def near_copies(seed, groups=6, copies=25):
    """Documents in groups of near copies, chains of copies of copies, and documents of their own."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghij") + str(rnd.randint(0, 300))
    rows = []
    for g in range(groups):
        text = [word() for _ in range(rnd.choice([3, 12, 40, 90, 160]))]
        for _ in range(copies):
            own = list(text)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                own[rnd.randrange(len(own))] = word()
            rows.append(" ".join(own))
            if g % 2:
                text = own
    rows += [" ".join(word() for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    common = " ".join(word() for _ in range(30))  # a passage that unlike documents share
    rows += [common + " " + " ".join(word() for _ in range(60)) for _ in range(40)]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("n, pct, seed", [(3, 90, 1), (5, 80, 2)])
def test_groups_of_near_copies(spark, n, pct, seed):
    rows = near_copies(seed)
    assert as_rows(J.join(docs(spark, rows), n, pct)) == brute(rows, n, pct)


def test_odd_rows(spark):
    rows = [*ODD_ROWS, (30, "One"), (31, "one two"), (32, "ONE\ttwo"), (None, "one")]
    d = docs(spark, rows)
    want = brute(rows, 3, 90)
    assert as_rows(J.join(d, 3, 90)) == want
    assert as_rows(J.join(clashing(d), 3, 90)) == want
    assert J.join(d.limit(0), 3, 90).count() == 0
    assert as_rows(J.join(docs(spark, [(1, "a b c d"), (2, "e f g h")]), 3, 90)) == [(1, 2, 1), (2, 2, 2)]


def test_one_document_of_each_group_stays(spark):
    rows = near_copies(3, groups=3, copies=8)
    first = {c for _, _, c in brute(rows, 5, 80)}
    kept = J.keep_one(clashing(docs(spark, rows)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"] for r in kept.collect()} == first


def test_one_row_of_each_group_stays_when_ids_repeat_or_are_missing(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(40))
    rows = [
        (1, text("a")),
        (2, text("a") + " end"),  # a near copy of 1 ...
        (2, text("clean")),  # ... whose doc_id a row of its own has too
        (3, text("b")), (3, text("b") + " end"), (3, text("b")),  # copies that share the smallest doc_id
        (None, text("c")), (None, text("c")), (None, text("c") + " end"),  # copies without doc_id
        (None, text("d")),
        (9, text("e")), (None, text("e")),
        (None, None), (None, None), (2, None),
    ]
    kept = [(r["doc_id"], r["text"]) for r in J.keep_one(docs(spark, rows)).collect()]
    assert {(1, text("a")), (2, text("clean")), (None, text("d")), (9, text("e"))} <= set(kept)
    assert len(kept) == 9 and kept.count((None, None)) == 2 and kept.count((2, None)) == 1
    assert sum(i == 3 for i, _ in kept) == 1 and sum(i is None and t is not None and t.startswith("c0") for i, t in kept) == 1


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_driver_tables(spark):
    d = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in d.select("doc_id", "text").collect()]
    assert as_rows(J.join(d, 3, 90)) == brute(rows, 3, 90)
