"""Language identification by rank-order profiles (out-of-place distance of frequent n-grams).

A text is lower-cased and cut into words of letters; its 1- to 3-grams, with a
mark at word ends, are ranked by frequency.  A language's profile is the ranking
over its training documents.  A document goes to the language whose profile
places its own most frequent n-grams best: the out-of-place distance sums how
far each n-gram's rank lies from its rank in the profile, or the profile's
length where it is missing.

Training takes a bounded sample of labelled rows: about ``max_docs`` documents a
language (all, where there are fewer), drawn by a hash of doc_id.  Prediction
reads every whole text and nothing else.

Defined cases: a null text or one without letters is ``und`` with score 0, as is
every text if nothing could be learned; ties go to the language first in order,
ties in frequency to the smaller n-gram; rows are judged one by one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, pick

PROFILE = 300
MAX_DOCS = 2000
#: Most languages that profiles are kept for, the most frequent ones first.
MAX_LANGUAGES = 500
#: Code points read at once of a very long text.
STEP = 1 << 20

NONE = np.int64(0x1FFFFF)  # no code point


@functools.cache
def _letters() -> np.ndarray:
    """Lower case of each code point if it is a letter, else 0."""
    table = np.zeros(0x110000, np.int64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _grams_of(letters: np.ndarray) -> np.ndarray:
    """1- to 3-grams as numbers of three 21-bit code points; 0 marks a word's end."""
    a, b = letters[:-1], letters[1:]
    pairs = (a << 42) | (b << 21) | NONE
    c = letters[1:-1] > 0
    three = ((letters[:-2] << 42) | (letters[1:-1] << 21) | letters[2:])[c]
    single = letters[letters > 0]
    return np.concatenate([(single << 42) | (NONE << 21) | NONE, pairs[(a > 0) | (b > 0)], three])


def count_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of the whole text, n-grams ascending."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.concatenate([[0], _letters()[codes], [0]])
    keep = letters > 0
    keep[1:] |= letters[:-1] > 0  # one mark between words
    keep[0] = True
    letters = letters[keep]
    if len(letters) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(letters) <= STEP:
        return np.unique(_grams_of(letters), return_counts=True)
    total: dict[int, int] = {}
    marks = np.flatnonzero(letters == 0)
    at = 0
    while at < len(letters) - 1:  # cut at word ends, so that no n-gram is lost or counted twice
        far = marks[np.searchsorted(marks, at + STEP)] if at + STEP < marks[-1] else marks[-1]
        for g, n in zip(*(x.tolist() for x in np.unique(_grams_of(letters[at : far + 1]), return_counts=True)), strict=True):
            total[g] = total.get(g, 0) + n
        at = far
    grams = np.array(sorted(total), np.int64)
    return grams, np.array([total[g] for g in grams.tolist()], np.int64)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The ``size`` most frequent n-grams, best first, ties by n-gram."""
    if len(grams) > 4 * size:  # sort only what can matter
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:size]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, size: int = PROFILE, max_docs: int = MAX_DOCS) -> dict[str, list[int]]:
    """Profiles by language from the rows with a lang: at most ``size`` n-grams each, best first."""
    d = pick(docs, "doc_id", "text", "lang").filter("lang IS NOT NULL AND doc_id IS NOT NULL")
    sizes = d.groupBy("lang").agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    share = {r["lang"]: min(1.0, max_docs / r["n"]) for r in top.collect()}  # MAX_LANGUAGES rows at most
    if not share:
        return {}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / F.lit(1_000_000.0)
    rate = F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, s)])
    some = d.withColumn("rate", F.element_at(rate, F.col("lang"))).filter(draw < F.col("rate")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                by_lang: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
                for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(count_grams(text))
                for lang, found in by_lang.items():
                    grams, where = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([c for _, c in found]), len(grams)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"]
                    )

    counts = map_arrow(some, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
    profiles: dict[str, list[int]] = {}
    for r in best.orderBy("lang", "place").collect():  # size * MAX_LANGUAGES rows at most
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


class Ranks:
    """The profiles as one table: rank of each known n-gram in each language."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.size, self.langs = size, sorted(profiles)
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            own = np.array(profiles[lang], np.int64)
            self.ranks[np.searchsorted(self.grams, own), j] = np.arange(len(own))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): 1 less the best distance as a share of the largest there could be."""
        own = ranked(*count_grams(text), self.size)
        if not len(own) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.grams, own)
        known = np.append(self.grams, -1)[at] == own
        r = self.ranks[np.where(known, at, len(self.grams))]
        far = np.where(r < 0, self.size, np.abs(r - np.arange(len(own))[:, None])).sum(axis=0)
        j = int(far.argmin())
        return self.langs[j], round(1 - float(far[j]) / (self.size * len(own)), 6)


def predict(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    d = pick(docs, "doc_id", "text")
    shared = d.sparkSession.sparkContext.broadcast(profiles)  # size * MAX_LANGUAGES numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(shared.value, size)
        for b in batches:
            langs, scores = zip(*[ranks.predict(t.as_py()) for t in b["text"]], strict=True) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    kind = d.schema["doc_id"].dataType.simpleString()
    return map_arrow(d, run, f"doc_id {kind}, lang_pred string, score double")


def digest(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out and judges all."""
    d = pick(docs, "doc_id", "text", "lang")
    profiles = learn(d.filter(~held_out(F.col("doc_id"))))
    out = predict(d, profiles)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
