"""Benchmark decontamination against windows looked up one by one."""

import hashlib
import os
import re

import pytest
from awkward import ODD_ROWS, as_rows, clashing, docs
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pedalflow.llm import decontaminate as D

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(documents, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    sizes = {len(x) for x in windows}
    out = []
    for i, t in documents:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def check(spark, documents, items, **more):
    got = D.digest(docs(spark, documents), bench(spark, items))
    assert as_rows(got) == brute([(r[0], r[1]) for r in documents], items)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.sampled_from("a b B c é ß 1 .".split()), max_size=60).map(" ".join), min_size=1, max_size=12),
    st.lists(st.lists(st.sampled_from("a b c É ß 1".split()), max_size=18).map("-".join), max_size=6),
)
def test_hits_are_the_contract(spark, texts, items):
    check(spark, list(enumerate(texts)), list(enumerate(items)))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_driver_tables(spark):
    d, b = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in d.select("doc_id", "text").collect()], [tuple(r) for r in b.select("item_id", "text").collect()])
    assert as_rows(D.digest(d, b)) == want
    assert sum(r[-1] for r in want) > 5


ITEM = "Which of these thirteen words, or more, Does the Item really have in it? é2"


def test_spans_in_the_original_text(spark):
    text = f"é🙂 start.. {ITEM.upper().replace('É', 'é')}!! the end and then: some\nother words"
    r = D.hit_spans(docs(spark, [(1, text), (2, "clean")]), bench(spark, [(7, ITEM)])).collect()
    assert [(x["doc_id"], text[x["start"] : x["stop"]].lower()) for x in r] == [(1, ITEM.lower())]


def test_benchmark_larger_than_one_automaton(spark):
    items = [(i, f"{ITEM} {i} {i + 1}") for i in range(6)] + [(6, "short one"), (7, None), (8, ""), (8, "short one")]
    d = docs(spark, [(i, f"x {ITEM} {i} {i + 1} y short one z") for i in range(8)] + ODD_ROWS)
    one, many = (D.find(d, bench(spark, items), max_windows=n).drop("text") for n in (1000, 4))
    assert as_rows(one) == as_rows(many)


def test_odd_rows_and_empty_tables(spark):
    items = [(1, ITEM), (2, None), (3, "")]
    documents = [*ODD_ROWS, (20, f"{ITEM} {ITEM}"), (20, f"{ITEM} {ITEM}")]
    check(spark, documents, items)
    check(spark, documents, [])
    d, b = docs(spark, documents), bench(spark, items)
    assert as_rows(D.digest(clashing(d), clashing(b))) == as_rows(D.digest(d, b))
    assert D.digest(d.limit(0), b).count() == 0
    kept = D.drop_contaminated(clashing(d), b)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert kept.count() == len(ODD_ROWS)


def test_a_text_wholly_of_benchmark_windows_takes_linear_time():
    import time

    item = "w" + " w".join(map(str, range(50)))
    automaton = D._automaton("long", [(w, ("1",)) for w in sorted(set(D.windows(item, 13)))])
    t = time.perf_counter()
    n, spans, items = D._scan(automaton, f"{item} " * 20_000, [], set())
    assert time.perf_counter() - t < 10
    assert n == 1_000_000 and spans == [(0, n)] and items == {"1"}
