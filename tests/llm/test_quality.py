"""Quality rules against a plain reading of the contract."""

import re
from collections import Counter

import pytest
from awkward import ODD_ROWS, as_rows, clashing, docs
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from pedalflow.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def check(spark, texts):
    df = quality.judge(docs(spark, list(enumerate(texts))))
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in df.collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_odd_rows(spark):
    check(spark, [t for _, t in ODD_ROWS])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "ä#", "\n", "\n\n", "\t", "|", "x."]), max_size=60).map(" ".join), min_size=1, max_size=30))
def test_base_is_the_contract(spark, texts):
    check(spark, texts)


PROSE = [
    "This is a line of ordinary prose with quite a few words in it.",
    "Another one follows, which says something else altogether!",
    "Does a third line, asking a question of the reader, hurt anybody?",
]


def test_lines_are_judged_one_by_one(spark):
    clean = "\n".join(PROSE)
    navigation = "Home | About us | Contact | Help | Imprint"
    text = f"{navigation}\n{clean}\nAll rights reserved."
    out = {r["doc_id"]: r for r in quality.judge(docs(spark, [(1, clean), (2, text), (3, "\n".join(f"Home{w} | About{w} | Contact{w} | Help{w}" for w in "abcdefghi") + "\n" + PROSE[0])])).collect()}
    assert out[1]["kept"] and out[1]["lost_chars"] == 0 and out[1]["clean_text"] == clean
    assert out[2]["kept"] and out[2]["clean_text"] == clean
    assert not out[3]["kept"] and not out[3]["base_failed"]


@pytest.mark.parametrize("line", ["A %%% &&& ### $$$ line. ***", "no sentence mark at all here", "A | B | C."])
def test_failing_lines(spark, line):
    assert quality.judge(docs(spark, [(1, line)])).first()["clean_text"] == ""


def test_clashing_columns_and_empty_table(spark):
    d = docs(spark, ODD_ROWS)
    plain = as_rows(quality.judge(d))
    assert as_rows(quality.judge(clashing(d))) == plain and len(plain) == len(ODD_ROWS)
    assert quality.judge(d.limit(0)).count() == 0
    assert quality.keep_clean(clashing(d)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_repeats_count_over_windows_that_overlap(spark):
    text = " ".join("abcdefgh") + " z " + " ".join("abcdefghi")
    check(spark, [text, text + " " + text, "a " * 50, " ".join("abcdefgh") * 2])


@pytest.mark.parametrize(
    "sentence",
    ["នេះ ជា ប្រយោគ មួយ ដែល មាន ពាក្យ ច្រើន ។", "ይህ ብዙ ቃላት ያሉት አንድ ተራ ዓረፍተ ነገር ነው ።", "یہ ایک عام جملہ ہے جس میں کئی الفاظ ہیں ۔", "นี่ คือ ประโยค ธรรมดา ที่ มี หลาย คำ",
     "这 是 一 个 有 很 多 词 的 普通 句子 。", "यह एक साधारण वाक्य है जिसमें कई शब्द हैं ।", "Սա սովորական նախադասություն է շատ բառերով ։"],
)
def test_scripts_with_other_marks_or_none_are_kept(spark, sentence):
    words = [" ".join(f"{w}{i}" if w[0].isalpha() else w for w in sentence.split()) for i in range(6)]  # no window twice
    r = quality.judge(docs(spark, [(1, "\n".join(words))])).first()
    assert r["kept"] and r["lost_chars"] == 0


def test_quick_patterns_find_what_the_rules_name(spark):
    lines = [f"a{chr(c)}b" for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000 and c != 10]
    lines += ["a | b · c", "| a |", "a|b |c d| ||", "» a", "x • y", "Terms of USE", "term of use", "skip to Main content", "uses cookies", "It İ CLICK HERE İ."]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i long, x string")
    x, once = F.col("x"), rf"(?<![^{quality.SPACE}])[|»›>•·](?![^{quality.SPACE}])"
    wrong = (x.rlike(quality.FIND_MARK) != x.rlike(quality.SENTENCE_MARK)) | (
        F.regexp_count(x, F.lit(quality.SEPARATOR)) != F.regexp_count(x, F.lit(once))
    ) | (x.rlike(quality.BOILERPLATE) & ~quality.may_be_boilerplate(x))
    assert d.filter(wrong).count() == 0
    assert d.filter(x.rlike(quality.BOILERPLATE)).count() == 4
