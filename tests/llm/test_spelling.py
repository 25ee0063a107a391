"""Spelling variants: words, signatures and joins against brute force."""

import os
import random
import re
import string
import zlib
from collections import Counter

import pytest
from awkward import ODD_ROWS, clashing, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from pedalflow.llm import registry
from pedalflow.llm import spelling as S
from pedalflow.llm.common import Scratch

SF_DIR = "/root/testdata/sf0.001"


def brute_words(rows, min_letters=6, min_count=5):
    found = Counter()
    for i, x in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", x or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if i is not None and (h := zlib.crc32(f"{i}:{w}".encode())) % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    return {w: n for w, n in found.items() if len(w) >= min_letters and n >= min_count}


def is_near(a, b):
    """Whether one inserted, deleted or replaced code point makes one the other."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute(words, ratio=5):
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in words:
        for n in (len(w) - 1, len(w), len(w) + 1):
            near[w] += [o for o in by_length.get(n, ()) if is_near(w, o)]
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows)


def found(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


letters = st.text(st.sampled_from("abcdeé×"), min_size=4, max_size=12)


@settings(max_examples=500, deadline=None)
@given(letters, st.integers(0, 12), st.sampled_from("abz÷"), st.sampled_from(["insert", "delete", "replace"]))
def test_near_words_share_a_signature(w, at, c, how):
    at = min(at, len(w) - 1)
    other = w[:at] + c + w[at:] if how == "insert" else w[:at] + w[at + 1 :] if how == "delete" else w[:at] + c + w[at + 1 :]
    for parts in (3, 5, 7):
        assert set(S.signatures(w, parts)) & set(S.signatures(other, parts))
    assert len(S.signatures(w, 5)) == 10


def test_near_words_share_each_finer_key(spark):
    r = random.Random(5)
    pairs = []
    for _ in range(400):
        w = "".join(r.choice("abcé") for _ in range(r.randrange(5, 12)))
        at, c = r.randrange(len(w) + 1), r.choice("abcz")
        pairs.append((w, r.choice([w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :]])))
    df = spark.createDataFrame(pairs, "a string, b string")
    from pyspark.sql import functions as F

    for keys in (S.halves, S.without_one):
        assert df.filter(~F.arrays_overlap(keys(F.col("a")), keys(F.col("b")))).isEmpty()


def test_runs_of_stretches_are_those_of_the_whole(monkeypatch):
    monkeypatch.setattr(S, "STEP", 7)
    x = "Ab cdefghijklmnopqrstuvwxyz é1é  ß_ÿ " * 5
    assert [w for part in S.runs(x) for w in part] == re.findall("[A-Za-zÀ-ÿ]+", x)


@pytest.mark.parametrize("least, most", [(16, 64), (2, 64), (2, 2)])
def test_groups_of_any_size_lose_no_pair(spark, least, most):
    """Anagrams and words of few letters share signatures and halves; the finer joins must find the same pairs."""
    r = random.Random(6)
    words = {"".join(r.choice("ab") for _ in range(r.randrange(6, 9))): r.randrange(5, 500) for _ in range(250)}
    words |= {"".join(r.sample("abcdef", 6)): r.randrange(5, 500) for _ in range(100)}
    words |= {"aaaaaa" + c: 5 + i for i, c in enumerate(string.ascii_lowercase)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(S.group(df, least=least, most=most)) == brute(words)
    work = Scratch(spark, "test")
    pairs = S.near_pairs(df, work, least=least, most=most)
    assert pairs.count() == sum(k for *_, k, _ in brute(words)) / 2
    work.remove()


def test_chains_of_forms_lead_to_one_root(spark):
    words = {"colour": 5, "colours": 25, "coloursx": 125, "coloursxy": 625, "coloursxyz": 3125, "alonely": 9, "tiedaa": 50, "tiedab": 50, "tiedac": 10}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = found(S.group(df))
    assert got == brute(words)
    assert ("colour", "colours", "coloursxyz", 5, 1, 25) in got and ("tiedac", "tiedaa", "tiedaa", 10, 2, 50) in got


def test_documents_against_brute_force(spark):
    r = random.Random(7)
    base = ["received", "Separate", "DEFINITELY", "occurred", "until", "naïveté", "ÉTÉ×été"]
    rows = []
    for i in range(400):
        x = [r.choice(base) for _ in range(12)]
        if i % 9 == 0:
            x.append(r.choice(["recieved", "seperate", "definitly", "occured", "recived"]))
        rows.append((i, " ".join(x)))
    rows += [(7, rows[7][1]), *((i, x) for i, x, *_ in ODD_ROWS), (None, "recieved " * 6), (9, "x" * 3_000_000)]
    d = clashing(docs(spark, rows))
    want = brute(brute_words(rows))
    assert len(want) > 8 and any(r[1] for r in want)
    assert found(S.variants(d)) == want
    empty = S.variants(d.limit(0))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0


def test_a_word_that_fills_a_third_of_all_rows(spark):
    rows = [(i, "common words " * 50 + ("commom" if i % 20 == 0 else "")) for i in range(300)]
    assert found(S.variants(docs(spark, rows))) == brute(brute_words(rows))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert found(registry.queries()["op13_spelling_variants"](spark, SF_DIR)) == brute(brute_words(rows))
