"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Normalising lower-cases A-Z and takes words of digits, a-z and characters from
U+0080 on.  The automaton's patterns are the items' windows of 13 words (a
shorter item is one window), written with a space before and after each word;
each document's normalised text passes through it once.  A match's place in the
normalised text gives its words, and those words' places in the original text
give the hit spans.

The automaton is sent to the executors and so must be bounded: about ``max_windows``
windows each.  A larger benchmark is cut by hash into that many automata; each takes
one more pass, whose hits are added to the earlier ones.

Defined cases: null and empty texts have no words and no hits; an item without
words has no window; items that share a window are all found by it, repeated
item rows count once by item_id; rows of documents are judged one by one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, pick, saved

WINDOW = 13
MAX_WINDOWS = 400_000

#: Bytes of the normalised text: words keep theirs (A-Z as a-z), all else is a space.
_KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
HITS = "doc_id {id}, text string, n_words long, hit array<struct<start:int,stop:int>>, items array<string>"
_automata: dict = {}


def words(text: str | None) -> list[bytes]:
    """The normalised words, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


def windows(text: str | None, width: int = WINDOW) -> set[bytes]:
    w = words(text)
    if len(w) < width:
        return {b" ".join(w)} if w else set()
    return {b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)}


def _automaton(key: str, patterns: list[tuple[bytes, tuple[str, ...]]]):
    """Built once a Python worker; one is held at a time."""
    import ahocorasick

    if key not in _automata:
        a = ahocorasick.Automaton()
        for p, items in patterns:
            a.add_word(f" {p.decode('latin-1')} ", (p.count(b" ") + 1, items))
        if patterns:
            a.make_automaton()
        _automata.clear()
        _automata[key] = a
    return _automata[key]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(automaton, text: str | None, spans: list[tuple[int, int]], items: set[str]):
    """(number of words, merged spans of hit words, items) with this automaton's hits added."""
    w = words(text)
    if w and len(automaton):
        norm = f" {b' '.join(w).decode('latin-1')} "
        new, seen, stop = [], 0, 0
        for end, (n, found) in automaton.iter(norm):  # by ascending end: words are counted on from the last hit
            stop += norm.count(" ", seen, end)
            seen = end
            new.append((stop - n, stop))
            items.update(found)
        spans = _merge([*spans, *new])
    return len(w), spans, items


def _pass(docs: DataFrame, patterns: list[tuple[bytes, tuple[str, ...]]]) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(patterns)  # at most max_windows
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _automaton(key, shared.value)
        for b in batches:
            n_words, hit, found = [], [], []
            for text, spans, items in zip(b["text"], b["hit"].to_pylist(), b["items"].to_pylist(), strict=True):
                n, s, i = _scan(a, text.as_py(), [(x["start"], x["stop"]) for x in spans], set(items))
                n_words.append(n)
                hit.append([{"start": x, "stop": y} for x, y in s])
                found.append(sorted(i))
            span = b.schema.field("hit").type
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["text"], pa.array(n_words, pa.int64()), pa.array(hit, span), pa.array(found, b.schema.field("items").type)],
                names=["doc_id", "text", "n_words", "hit", "items"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs, run, HITS.format(id=kind))


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The items' distinct windows, each with its items' ids as text; saved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(w, i) for t, i in zip(b["text"].to_pylist(), b["item"].to_pylist(), strict=True) for w in windows(t, width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.binary()), pa.array([i for _, i in found], pa.string())], names=["window", "item"]
            )

    items = pick(benchmark, "item_id", "text").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    each = map_arrow(items, run, "window binary, item string")
    return saved(each.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")), "windows")


def find(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """doc_id, text, n_words, ``hit`` (merged spans of word numbers) and ``items`` of every document."""
    all_windows = benchmark_windows(benchmark, width)
    shards = max(1, -(-all_windows.count() // max_windows))
    none = F.array().cast("array<struct<start:int,stop:int>>")
    out = pick(docs, "doc_id", "text").select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"), none.alias("hit"), F.array().cast("array<string>").alias("items")
    )
    for shard in range(shards):  # the driver holds one automaton's windows at a time
        some = all_windows.filter(F.pmod(F.xxhash64("window"), F.lit(shards)) == shard)
        patterns = sorted((bytes(r["window"]), tuple(r["items"])) for r in some.toLocalIterator())
        out = _pass(saved(out, "hits") if shard else out, patterns)
    return out


def hit_chars(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of word numbers as spans of code points of the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    inside = np.frombuffer(raw.translate(_KEEP), np.uint8) != 32
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    code = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [(int(code[starts[a]]), int(code[stops[b - 1]])) for a, b in spans]


def _n_hit():
    return F.aggregate("hit", F.lit(0).cast("long"), lambda s, x: s + x.getField("stop") - x.getField("start"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    f = find(docs, benchmark).withColumn("n_hit", _n_hit())
    return f.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def hit_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, start, stop (code points of the original text) of each hit passage."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, starts, stops = [], [], []
            for i, text, spans in zip(b["doc_id"], b["text"], b["hit"].to_pylist(), strict=True):
                for s, e in hit_chars(text.as_py() or "", [(x["start"], x["stop"]) for x in spans]):
                    ids.append(i.as_py())
                    starts.append(s)
                    stops.append(e)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, b.schema.field("doc_id").type), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())],
                names=["doc_id", "start", "stop"],
            )

    found = find(docs, benchmark).filter(F.size("hit") > 0).select("doc_id", "text", "hit")
    return map_arrow(found, run, f"doc_id {kind}, start long, stop long")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns of ``documents``.

    The automaton's verdict goes with the whole row through the same pass, so
    no join on doc_id is needed.
    """
    cols = ("text", "lang", "source", "n_chars")
    d = pick(docs, "doc_id", *cols)
    rows = d.select(F.struct("doc_id", "lang", "source", "n_chars").alias("doc_id"), "text")
    f = find(rows, benchmark).withColumn("n_hit", _n_hit())
    clean = f.filter(~((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))))
    return clean.select("doc_id.doc_id", "text", "doc_id.lang", "doc_id.source", "doc_id.n_chars")


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
