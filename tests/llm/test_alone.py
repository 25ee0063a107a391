"""Sets that are told to be alone against all pairs."""

import collections
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from awkward import docs

from pedalflow.llm import alone as A
from pedalflow.llm import jaccard as J
from pedalflow.llm.common import Scratch


def similar(x, y, pct):
    both = len(np.intersect1d(x, y))
    return 100 * both >= pct * (len(x) + len(y) - both)


def some_sets(seed, pct, count=60):
    """Sets of all sizes; each has one that is as far from it as links reach, larger, smaller, or changed; some share a common part."""
    r = np.random.default_rng(seed)
    new = lambda n: r.integers(0, 2**64, n, dtype=np.uint64)
    sets, common = [], new(300)
    for i in range(count):
        n = int(r.choice([1, 2, 3, 5, 10, 40, 150, 700]))
        x = np.unique(np.concatenate([new(n), common[: r.integers(0, 2 * n)] if i % 3 == 0 else new(0)]))
        n = len(x)
        out = 2 * n * (100 - pct) // (100 + pct)
        more, less, moved = (100 - pct) * n // pct, (100 - pct) * n // 100, out // 2
        y = [lambda: np.concatenate([x, new(more)]), lambda: x[less:], lambda: np.concatenate([x[moved:], new(moved)])][i % 4 % 3]()  # noqa: B023
        sets += [x, np.unique(y)] if i % 4 != 3 else [x]
    return sets


def rows_of(sets, pct):
    told = [A.told(s, pct) for s in sets]
    return pa.RecordBatch.from_pydict(
        {"id": list(range(len(sets))), "told": [t[0] for t in told], "sure": [t[1] for t in told], "slack": [t[2] for t in told]},
        schema=pa.schema([("id", pa.int64()), ("told", pa.binary()), ("sure", pa.int64()), ("slack", pa.int64())]),
    )


def by_hand(sets, pct, bits, size):
    """The ids found when batches have ``size`` sets."""
    whole = rows_of(sets, pct)
    dealt = pa.Table.from_batches([A._packed([whole.slice(at, size)], at, bits) for at in range(0, len(sets), size)])
    groups = lambda t, c: [((k,), t.filter(pc.equal(t[c], k))) for k in t[c].unique()]
    met = pa.concat_tables([A._met(k, t) for k, t in groups(dealt, "part")])
    return {i for k, t in groups(met, "batch") for i in A._open(k, t)["id"].to_pylist()}


@pytest.mark.parametrize("pct", [50, 80, 90, 100])
@pytest.mark.parametrize("bits, size", [(0, 7), (3, 1000), (5, 20)])
def test_a_set_that_has_a_similar_one_is_never_alone(pct, bits, size):
    sets = some_sets(pct + bits, pct)
    near = {i for i, x in enumerate(sets) for j, y in enumerate(sets) if i != j and similar(x, y, pct)}
    found = by_hand(sets, pct, bits, size)
    assert near <= found and len(near) > 20
    own = [np.arange(s, s + 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for s in range(0, 40_000, 400)]
    assert len(by_hand([np.sort(s) for s in own], pct, bits, size)) < 10 or pct == 50


def test_limits_never_rise_with_the_size():
    for pct in (50, 80, 95, 100):
        limits = [A._limit(n, pct) for n in range(1, 5000)]
        assert limits == sorted(limits, reverse=True)


def test_numbers_come_back():
    r = np.random.default_rng(1)
    for top in (1, 5, 300, 10**6):
        x = np.sort(r.integers(0, top, 50))
        assert (A._places(A._steps(x)) == x).all() and len(A._places(A._steps(x[:0]))) == 0
    x = r.integers(0, 2**40, 50, dtype=np.uint64)
    assert (A._numbers(A._bytes(x, 5), 5) == x).all()


def test_an_element_of_all_sets_travels_once_a_batch():
    r = np.random.default_rng(2)
    common = np.sort(r.integers(0, 2**64, 200, dtype=np.uint64))
    sent = A._packed([rows_of([np.unique(np.concatenate([common, r.integers(0, 2**64, 1, dtype=np.uint64)])) for _ in range(500)], 80)], 0, 4)
    heads = [p < 0 for p in sent["part"].to_pylist()]
    assert sum(len(x or b"") for c in ("own", "other") for x, h in zip(sent[c].to_pylist(), heads, strict=True) if not h) <= 3 * 700


@pytest.mark.parametrize("elements", [1, 40 * A.RANGE])
def test_of_a_table(spark, elements):
    sets = some_sets(5, 80)
    near = {i for i, x in enumerate(sets) for j, y in enumerate(sets) if i != j and similar(x, y, 80)}
    work = Scratch(spark, "test")
    table = work.saved(spark.createDataFrame(rows_of(sets, 80).to_pandas()).repartition(3), "sets")
    found = {r["id"] for r in A.others(table, elements).collect()}
    assert near <= found and len(found) < len(sets)
    assert A.others(table.limit(0), 0).count() == 0
    work.remove()


def test_documents_that_share_passages_get_no_keys(spark, monkeypatch):
    """Every set once had a key for each of its blocks: 4.1 GB of disk for 0.51 GB of documents, nearly all of them alone."""
    r = random.Random(4)
    text = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    passages = [text(25) for _ in range(8)]
    rows = [(i, " ".join([text(120), r.choice(passages), text(60), r.choice(passages)])) for i in range(300)]
    rows += [(300 + i, rows[i][1] + " " + text(2)) for i in range(5)]
    keyed = collections.Counter()
    inner = J.linked

    def counted(found, *more, **named):
        keyed.update(x["id"] for x in found.collect())
        return inner(found, *more, **named)

    monkeypatch.setattr(J, "linked", counted)
    kept = J.keep_one(docs(spark, rows))
    assert {x["doc_id"] for x in kept.collect()} == set(range(300))
    assert 10 <= len(keyed) < 60
