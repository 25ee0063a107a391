"""Spelling variant grouping by PartEnum signatures.

Words are counted over the whole corpus.  Two words are near if one inserted, deleted or
replaced letter makes one the other.  Then their letter multisets, as binary vectors with
a dimension for every letter's first, second, ... occurrence, differ in at most two
places.  The dimensions are dealt to ``parts`` parts; two such vectors agree on all but two
parts at least, so a word's signatures are its vectors on every choice of parts - 2 parts
(Arasu, Ganti, Kaushik, PartEnum, 2006, with one level of parts).  Words are equi-joined on
signatures and verified by their edit distance.

A signature may be shared by many words: anagrams all have the same.  Words of such a
group are not paired.  Of two near words, either the first halves or the last halves are
equal, so members of a signature with more than ``least`` words are joined on (signature,
half) instead; and those that share one of these with more than ``most`` words on
(signature, word without one letter, its place), which no more words can share than there
are letters.  All three keys are exact: no near pair is lost at any group size.

A word's form is its near word of largest count (ties: smallest in code-point order), if
that is ``ratio`` times as frequent; roots follow forms to the last by pointer doubling.

Defined cases: null and empty texts have no words; a row without doc_id is scanned
but loses no letter; repeated rows count each; a text of any length is scanned in
stretches; an empty table gives an empty result; extra columns, whatever their names,
are left behind.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, map_arrow, pick, saved

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Letters by how common they are in Latin writing, so that parts get even shares of a word.
COMMON = "eaintosrlhducmpgbfvqywkjxz"
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
#: Parts that the dimensions are dealt to.
PARTS = 5
#: Words of a signature, and of a signature and half, that are paired at most.
LEAST, MOST = 16, 64
#: Code points scanned at once, and words a task counts before it hands them on.
STEP, HELD = 1 << 20, 400_000


def runs(text: str) -> Iterator[list[str]]:
    """The maximal runs of letters, stretch by stretch."""
    at = 0
    while at < len(text):
        end = min(len(text), at + STEP)
        if end < len(text) and (more := LETTERS.match(text, end)):
            end = more.end()
        yield LETTERS.findall(text, at, end)
        at = end


def spelled(doc_id: object, run: str, modulus: int = 199) -> str:
    """The run in lower case, without one letter where the hash of document and run says so."""
    word = run.translate(_LOWER)
    if doc_id is None:
        return word
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    return word if h % modulus else word[: h % len(word)] + word[h % len(word) + 1 :]


def _count(batches: Iterator[pa.RecordBatch], min_letters: int) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return b

    for b in batches:
        for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
            own: Counter[str] = Counter()
            for found in runs(text.as_py() or ""):
                own.update(found)
            doc_id = doc_id.as_py()
            for run, n in own.items():
                if len(run) >= min_letters and len(word := spelled(doc_id, run)) >= min_letters:
                    held[word] += n
            if len(held) > HELD:
                yield out()
    yield out()


def count_words(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words of ``min_letters`` letters and ``min_count`` occurrences in all documents."""
    d = pick(docs, "doc_id", "text").filter("text IS NOT NULL")
    found = map_arrow(d, lambda b: _count(b, min_letters), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def signatures(word: str, parts: int = PARTS) -> list[int]:
    """Numbers of which words whose letter multisets differ in at most two places share one."""
    held: list[list[str]] = [[] for _ in range(parts)]
    seen: Counter[str] = Counter()
    for c in sorted(word):
        seen[c] += 1
        place = COMMON.find(c)
        place = (place if place >= 0 else ord(c)) + (seen[c] - 1) * 2
        turn = place % (2 * parts)  # dealt there and back again
        held[turn if turn < parts else 2 * parts - 1 - turn].append(c)
    own = ["".join(p) for p in held]
    return [
        xxhash.xxh64_intdigest(",".join(chosen), i)
        for i, chosen in enumerate(itertools.combinations(own, parts - 2))
    ]


def _signed(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = [np.array(signatures(w, parts), np.uint64).view(np.int64) for w in b["word"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["word"], b["n"], pa.array(keys, pa.list_(pa.int64()))], names=["word", "n", "keys"])


def halves(word: Column) -> Column:
    """Numbers of which near words share one: first and last half, as words of this length or one less are cut."""
    n = F.length(word)

    def of(length: Column) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        first = F.xxhash64(F.lit(0), length, F.substring(word, F.lit(1), half))
        return [first, F.xxhash64(F.lit(1), length, F.substring(word, n - (length - half) + 1, n))]

    return F.array(*of(n), *of(n - 1))


def without_one(word: Column) -> Column:
    """Numbers that near words share one of: the word without each letter, and for longer words, the word itself.

    Words of one length are alike without the letter at one place; a word is what a
    longer one is without a letter.
    """
    places = F.sequence(F.lit(1), F.length(word))
    left = F.transform(places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    same = F.zip_with(left, places, lambda w, i: F.xxhash64(F.lit(2), w, i))
    return F.concat(same, F.transform(left, lambda w: F.xxhash64(F.lit(3), w)), F.array(F.xxhash64(F.lit(3), word)))


def _shared(rows: DataFrame, work: Scratch, name: str) -> DataFrame:
    """key, word, n, c (members of the key) of the keys with more than one word; saved."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    # dealt out once more in the join: then Spark sees both sides' sizes and can split a hot key
    return work.saved(rows.join(sizes.withColumn("key", F.col("key") + 0), "key"), name)


def _pairs(members: DataFrame) -> DataFrame:
    a = members.select("key", F.col("word").alias("a"), F.col("n").alias("na"))
    b = members.select("key", F.col("word").alias("b"), F.col("n").alias("nb"))
    near = F.levenshtein("a", "b", 1) == 1
    return a.join(b, "key").filter((F.col("a") < F.col("b")) & near).select("a", "na", "b", "nb")


def near_pairs(words: DataFrame, work: Scratch, parts: int = PARTS, least: int = LEAST, most: int = MOST) -> DataFrame:
    """a, na, b, nb: every two words (a < b) of ``words`` (word, n) that are near, once; saved."""
    signed = work.saved(map_arrow(words, lambda b: _signed(b, parts), "word string, n long, keys array<long>"), "signed")
    one = _shared(signed.select(F.explode("keys").alias("key"), "word", "n"), work, "signatures")

    def finer(members: DataFrame, keys: Column) -> DataFrame:
        each = members.select("key", "word", "n", F.explode(keys).alias("finer"))
        return each.select(F.xxhash64("key", "finer").alias("key"), "word", "n").distinct()

    two = _shared(finer(one.filter(F.col("c") > least), halves(F.col("word"))), work, "halves")
    # a word meets another in many signatures; by that key alone it does so once
    left = two.filter(F.col("c") > most).select(F.lit(0).alias("key"), "word", "n").distinct()
    three = _shared(finer(left, without_one(F.col("word"))), work, "letters")
    found = [_pairs(one.filter(F.col("c") <= least)), _pairs(two.filter(F.col("c") <= most)), _pairs(three)]
    return work.saved(found[0].union(found[1]).union(found[2]).distinct(), "near")


def _roots(forms: DataFrame, steps: int, work: Scratch) -> DataFrame:
    """word, root: the last word that forms lead to, by ``steps`` doublings."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(steps):
        up = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = work.saved(at.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return at


def group(words: DataFrame, ratio: int = RATIO, parts: int = PARTS, least: int = LEAST, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n); saved."""
    work = Scratch(words.sparkSession, "spelling")
    words = work.saved(words, "words")
    near = near_pairs(words, work, parts, least, most)
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).union(
        near.select("b", "a", "na")
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("m"), F.col("other"))).alias("top"))
    known = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.col1") >= ratio * F.col("n"), F.struct(F.col("top.other").alias("form"), (-F.col("top.col1")).alias("n"))).alias("up"),
    )
    known = work.saved(known.select("word", "up.form", "n", "n_near", F.col("up.n").alias("form_n")), "known")
    forms = known.filter("form IS NOT NULL")
    # a form is ``ratio`` times as frequent, which bounds the length of a chain
    top, depth = (words.agg(F.max("n")).first()[0] or 0), 0
    while top >= ratio > 1:
        top, depth = top // ratio, depth + 1
    roots = _roots(forms, max(1, depth).bit_length(), work)
    out = known.join(roots, "word", "left")
    out = out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    out = saved(out, "variants")
    work.remove()
    return out


def variants(docs: DataFrame) -> DataFrame:
    """The words of all documents with their forms and roots."""
    return group(count_words(docs))
