"""Language identification: counting, ranking, held-out accuracy."""

import os
import zlib
from collections import Counter

import pytest
from awkward import ODD_ROWS, clashing, docs

from pedalflow.llm import language as L

SF_DIR = "/root/testdata/sf0.01"


def plain_grams(text):
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    grams = Counter()
    for w in words:
        for n in (1, 2, 3):
            marked = f" {w} "
            for i in range(len(marked) - n + 1):
                g = marked[i : i + n]
                if g != " " and not (n == 3 and g[1] == " "):
                    grams[g] += 1
    # the mark between two words is shared, so pairs and triples are as counted; single marks are none
    return grams


def decode(code):
    parts = [code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF]
    return "".join(" " if p == 0 else chr(p) for p in parts if p != int(L.NONE))


@pytest.mark.parametrize("text", ["Hello, hello world!", "a", "é 9 ß", "Ünder über 12 unter", "x-y z"])
def test_counts(text):
    grams, counts = L.count_grams(text)
    assert {decode(g): n for g, n in zip(grams.tolist(), counts.tolist(), strict=True)} == dict(plain_grams(text))


def test_long_texts_are_counted_whole(monkeypatch):
    text = "some words in a row, Größe und Maß " * 300
    whole = [x.tolist() for x in L.count_grams(text)]
    monkeypatch.setattr(L, "STEP", 100)
    assert [x.tolist() for x in L.count_grams(text)] == whole


@pytest.mark.parametrize("text", [None, "", " \n", "123 !?", "🙂"])
def test_nothing_to_judge(text):
    assert L.Ranks({"en": L.count_grams("the text")[0].tolist()}).predict(text) == ("und", 0.0)


def test_out_of_place_distance():
    a, b = L.count_grams("aaa aa a")[0], L.count_grams("bbb bb b")[0]
    r = L.Ranks({"a": L.ranked(*L.count_grams("aaa aa a")).tolist(), "b": L.ranked(*L.count_grams("bbb bb b")).tolist()})
    assert len(a) and len(b)
    assert r.predict("aaa aa a") == ("a", 1.0)
    assert r.predict("zzz")[1] == 0.0
    assert r.predict("zzz")[0] == "a"  # a tie goes to the first


def test_learning_uses_neither_held_out_rows_nor_nulls(spark):
    rows = [(i, "one two three", "en") for i in range(40)] + [(i, "uno dos tres", None) for i in range(40, 60)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5] + [(r[0], "eins zwei drei", "de") for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    out = {r["doc_id"]: r for r in L.digest(docs(spark, rows)).collect()}
    assert {r["lang_pred"] for r in out.values()} == {"en"}
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in out)


def test_odd_rows(spark):
    d = docs(spark, [*ODD_ROWS, *[(100 + i, "plain words of one language", "en") for i in range(9)]])
    for df in (d, clashing(d)):
        out = L.digest(df).collect()
        assert len(out) == len(ODD_ROWS) + 9
        assert {r["lang_pred"] for r in out if r["doc_id"] in (1, 2, 3)} == {"und"}
        assert all(r["held_out"] is not None and 0 <= r["score"] <= 1 for r in out)
    assert L.digest(d.limit(0)).count() == 0
    assert {r["lang_pred"] for r in L.digest(d.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = L.digest(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(out) > 100 and sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.98
