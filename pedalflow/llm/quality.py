"""Quality rules: line-first cleaning, then a verdict on what is left (DataFrame functions only).

Every line is judged by itself:

* punctuation - a line without any sentence mark, in a script that has them, or with
  more punctuation characters than words, is not prose;
* navigation - a line of short items between separators (``Home | About | Help``);
* boilerplate - cookie, script, rights and sign-up notices, placeholder text.

Failing lines are taken out.  A document is rejected when the base rules fail
(too few words, too many repeated 8-word windows) or when the removed lines
held more than ``max_lost_pct`` per cent of its word characters.

Defined cases: a null text has no words, fails the base and cleans to null; an
empty text likewise cleans to ''.  Rows are judged one by one, so repeated ids
and ties do not matter.  Windows are compared by the 64-bit hash of their eight
words' hashes within one text.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, let, pick

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
MAX_LOST_PCT = 50

HAS_WORD = rf"[^{SPACE}]"
# The code points of Unicode's Sentence_Terminal property, and those of … and ། beside them.
MARKS = (
    r".!?\u2026\u0F0D\u0589\u061D-\u061F\u06D4\u0700-\u0702\u07F9\u0837\u0839\u083D\u083E\u0964\u0965\u104A\u104B\u1362\u1367\u1368"
    r"\u166E\u1735\u1736\u17D4\u17D5\u1803\u1809\u1944\u1945\u1AA8-\u1AAB\u1B4E\u1B4F\u1B5A\u1B5B\u1B5E\u1B5F\u1B7D-\u1B7F\u1C3B\u1C3C"
    r"\u1C7E\u1C7F\u203C\u203D\u2047-\u2049\u2CF9-\u2CFB\u2E2E\u2E3C\u2E53\u2E54\u3002\uA4FF\uA60E\uA60F\uA6F3\uA6F7\uA876\uA877"
    r"\uA8CE\uA8CF\uA92F\uA9C8\uA9C9\uAA5D-\uAA5F\uAAF0\uAAF1\uABEB\uFE12\uFE15\uFE16\uFE52\uFE56\uFE57\uFF01\uFF0E\uFF1F\uFF61"
)
#: Thai and Lao end sentences by a space; a line with their letters needs no mark.
SENTENCE_MARK = rf"[{MARKS}\u0E01-\u0E3A\u0E40-\u0E4E\u0E81-\u0EDF]"
#: The same; ASCII letters are not compared with every range of the class.
FIND_MARK = rf"[.!?]|(?![\x00-\x7F]){SENTENCE_MARK}"
PUNCTUATION = r"\p{Punct}"
#: A word that is one separator.
SEPARATOR = rf"[|»›>•·](?![^{SPACE}])(?<![^{SPACE}].)"
BOILERPLATE = (
    r"(?i)(lorem ipsum|enable javascript|uses? cookies|cookie policy|privacy policy|terms of (use|service)"
    r"|all rights reserved|sign up for our|subscribe to our|click here|skip to (main )?content|back to top"
    r"|powered by wordpress)"
)
#: Every match of ``BOILERPLATE`` holds one of these, in small letters.
BOILERPLATE_HINTS = (
    "lorem ipsum", "enable javascript", " cookies", "cookie policy", "privacy policy", "terms of ", "all rights reserved",
    "sign up for our", "subscribe to our", "click here", "skip to ", "back to top", "powered by wordpress",
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _repeated_words(w: Column) -> Column:
    """Words of ``w`` inside 8-word windows that occur twice or more."""
    n = F.size(w)

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))

    keys = let(F.transform(w, lambda x: F.xxhash64(x)), windows)  # each word is hashed once, not for every window

    def covered(starts: Column) -> Column:
        # starts ascend; each window adds the words up to the next repeated window's start
        steps = F.transform(
            starts, lambda v, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - v, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def from_sorted(s: Column) -> Column:
        key = lambda j: F.get(s, j).getField("k")
        twins = F.filter(
            s,
            lambda e, j: ((j > 0) & (key(F.greatest(j - 1, F.lit(0))) == e.getField("k")))
            | F.coalesce(key(j + 1) == e.getField("k"), F.lit(False)),
        )
        return let(F.sort_array(F.transform(twins, lambda e: e.getField("i"))), covered)

    def from_keys(k: Column) -> Column:
        pairs = F.transform(k, lambda x, i: F.struct(x.alias("k"), i.alias("i")))
        return F.when(F.size(F.array_distinct(k)) == F.size(k), 0).otherwise(let(F.sort_array(pairs), from_sorted))

    return F.when(n < WINDOW + 1, 0).otherwise(let(keys, from_keys))


def may_be_boilerplate(text: Column) -> Column:
    """Whether any line of the text can break the boilerplate rule: looked for by plain comparison."""
    return let(F.lower(text), lambda low: functools.reduce(lambda a, b: a | b, [low.contains(h) for h in BOILERPLATE_HINTS]))


def line_fails(line: Column, boilerplate: Column | None = None) -> Column:
    """Whether one line breaks a punctuation, navigation or boilerplate rule; ``boilerplate`` says if its text can."""
    words = F.regexp_count(line, F.lit(WORD))
    punctuation = ~line.rlike(FIND_MARK) | (F.regexp_count(line, F.lit(PUNCTUATION)) > words)
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    navigation = (separators >= 2) & (separators * 5 >= words)
    notice = line.rlike(BOILERPLATE)
    return line.rlike(HAS_WORD) & (punctuation | navigation | (notice if boilerplate is None else boilerplate & notice))


def _word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, rf"[{SPACE}]+", ""))


def judge(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    max_repeat_pct: int = MAX_REPEAT_PCT,
    max_lost_pct: int = MAX_LOST_PCT,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Counts, verdict and cleaned text of every document; ``carry`` names the columns taken along.

    ``lost_chars`` are the word characters of the removed lines, ``clean_text``
    the other lines joined by \\n in their order (null for a null text).
    """
    d = pick(docs, *carry, *(["text"] if "text" not in carry else []))
    t = F.coalesce(F.col("text"), F.lit(""))

    def measure(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w).cast("long").alias("n_repeat_words"))

    def lines(all_lines: Column) -> Column:
        full = F.filter(all_lines, lambda x: x.rlike(HAS_WORD))
        kept = let(may_be_boilerplate(t), lambda can: F.filter(all_lines, lambda x: ~line_fails(x, can)))
        return F.struct(
            let(full, lambda f: (F.size(f) - F.size(F.array_distinct(f))).cast("long")).alias("n_dup_lines"),
            F.array_join(kept, "\n").alias("clean_text"),
        )

    m, ln = F.col("m"), F.col("ln")
    out = d.withColumn("m", let(words_of(t), measure)).withColumn("ln", let(F.split(t, "\n"), lines))
    out = out.select(
        *carry,
        m["n_words"].alias("n_words"),
        _word_chars(t).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        ln["n_dup_lines"].alias("n_dup_lines"),
        m["n_repeat_words"].alias("n_repeat_words"),
        F.when(F.col("text").isNotNull(), ln["clean_text"]).alias("clean_text"),
    )
    base_failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct)
    lost = F.col("word_chars") - _word_chars(F.coalesce(F.col("clean_text"), F.lit("")))
    out = out.withColumn("lost_chars", lost).withColumn("base_failed", base_failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * max_lost_pct))


def keep_clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their failing lines taken out; the columns of ``documents``."""
    judged = judge(docs, carry=("doc_id", "text", "lang", "source", "n_chars"))
    return judged.filter("kept").select(
        "doc_id", F.col("clean_text").alias("text"), "lang", "source", F.length("clean_text").cast("long").alias("n_chars")
    )
