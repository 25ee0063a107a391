"""Best-fit packing by best-two-fit over a histogram of lengths.

Documents are tokenized once; those longer than a sequence are cut into full
pieces, the first one shorter.  How many pieces there are of each length is all
that the packing needs: a histogram of at most ``capacity`` rows, whatever the
corpus.  On it a bin is filled greedily with the longest lengths that fit, then
its shortest piece is replaced by the two unpacked lengths that fill the grown
gap best, if they fill it better.  As long as every length of the bin lasts, the
next bin comes out the same, so one pattern stands for a run of bins.

The pieces then take their places in parallel: the pieces of one length are
numbered by (task, place in the task), without gathering them, and a piece's
number among its length names the run of bins and the offset it goes to.

Defined cases: a null or empty text is the end token alone; documents are told
apart row by row, so repeated doc_ids are packed each for themselves; ties are
broken by length, then by partition and place.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, pick, reachable, saved

CAPACITY = 1024
END_ID = 2

#: How byte-level BPE cuts a text before it merges (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of these characters are cut alike by every regular expression engine.
LATIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*")

_tokenizers: dict = {}


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _tokenizer(path: str):
    """(tokenizer, the same merges as a function from Latin texts to ids or None, special strings), once a worker.

    The function runs the file's merges through tiktoken, several times as fast.
    It only stands in where it must give the same ids: plain byte-level BPE whose
    ids ascend with the merges.
    """
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, pre = file["model"], file["pre_tokenizer"] or {}
        special = [t["content"] for t in file["added_tokens"]]
        vocab = {t: i for t, i in model["vocab"].items() if t not in special}
        merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model.get("merges", [])]
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not file["normalizer"]
        fast = None
        if plain and merged == list(range(256, 256 + len(merged))) and len(vocab) == 256 + len(merged):
            byte_of = _byte_of()
            ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}
            fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        _tokenizers.clear()
        _tokenizers[path] = Tokenizer.from_file(path), fast, special
    return _tokenizers[path]


def token_bytes(path: str, texts: list[str]) -> list[bytes]:
    """Little-endian 32-bit ids of each text."""
    tok, fast, special = _tokenizer(path)
    out = []
    for t in texts:
        if fast and LATIN.fullmatch(t) and not any(s in t for s in special):
            ids = fast(t)
        else:
            ids = tok.encode(t, add_special_tokens=False).ids
        out.append(np.asarray(ids, "<u4").tobytes())
    return out


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, task, nth (place among its length in the task) [, ids]."""
    d = pick(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()
    end = np.asarray([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounds what one batch of texts holds at once
                b = batch.slice(at, 256)
                rows: list[tuple] = []
                tokens = token_bytes(tokenizer, [t or "" for t in b["text"].to_pylist()])
                for i, ids in enumerate(tokens):
                    ids += end
                    for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                        own = ids[4 * s : 4 * (s + n)]
                        rows.append((i, k, s, n, zlib.crc32(own), int(seen[n]), own))
                        seen[n] += 1
                cols = list(zip(*rows, strict=True))
                out = [b["doc_id"].take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32())]
                out += [pa.array(c, pa.int64()) for c in cols[2:5]]
                out += [pa.array([task] * len(rows), pa.int32()), pa.array(cols[5], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
                if with_ids:
                    out.append(pa.array(cols[6], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    return map_arrow(d, run, schema + (", ids binary" if with_ids else ""))


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Runs of bins: (lengths in the bin, number of bins), packing ``counts`` pieces of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    runs: list[tuple[list[int], int]] = []
    while lengths:
        used: dict[int, int] = {}
        bin_, gap = [], capacity

        def free(n: int) -> int:
            return left[n] - used.get(n, 0)

        at = len(lengths)
        while gap and (at := min(at, bisect.bisect_right(lengths, gap))):
            n = lengths[at - 1]
            take = min(free(n), gap // n)
            if not take:
                at -= 1
                continue
            bin_ += [n] * take
            used[n] = used.get(n, 0) + take
            gap -= n * take
        if gap and len(bin_) > 1:  # the shortest piece against two that fill its room and the gap better
            small = bin_[-1]
            used[small] -= 1
            room, best, pair = gap + small, small, None
            i, j = 0, bisect.bisect_right(lengths, room) - 1
            while i <= j:
                a, b = lengths[i], lengths[j]
                enough = free(a) >= 2 if i == j else free(a) >= 1 and free(b) >= 1
                if a + b > room:
                    j -= 1
                elif not enough:
                    if i == j or not free(a):
                        i += 1
                    else:
                        j -= 1
                else:
                    if a + b > best:
                        best, pair = a + b, (a, b)
                    i += 1
            if pair:
                bin_[-1:] = [pair[1], pair[0]]
                for n in pair:
                    used[n] = used.get(n, 0) + 1
            else:
                used[small] += 1
        times = min(left[n] // u for n, u in used.items() if u)
        runs.append((bin_, times))
        for n, u in used.items():
            left[n] -= u * times
        lengths = [n for n in lengths if left[n]]
    return runs


def _places(runs: list[tuple[list[int], int]]) -> dict[int, list[np.ndarray]]:
    """Per length: numbers from which each run's slot starts, its first sequence, its offset, how many share a bin."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for bin_, times in runs:
        offset = 0
        for n in bin_:
            found.setdefault(n, []).append((taken.get(n, 0), first, offset))
            taken[n] = taken.get(n, 0) + times
            offset += n
        first += times
    return {n: [np.array(c, np.int64) for c in zip(*x, strict=True)] for n, x in found.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset; ``with_ids`` adds its ids as little-endian 32-bit words."""
    cut_up = saved(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    by_task = cut_up.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    places = docs.sparkSession.sparkContext.broadcast(_places(best_two_fit(histogram, capacity)))  # <= capacity lengths

    # numbers before each task's pieces of a length: one row per length and task, prefix-summed per length
    from pyspark.sql import Window

    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("length", "task", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long").alias("before"))
    numbered = cut_up.join(before, ["length", "task"]).withColumn("nth", F.col("nth") + F.col("before")).drop("before", "task")

    reachable(docs.sparkSession)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, nth: pd.Series) -> pd.DataFrame:
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        ln, at = length.to_numpy(), nth.to_numpy()
        for n in np.unique(ln):
            own = ln == n
            starts, firsts, offsets = places.value[int(n)]
            k = np.searchsorted(starts, at[own], side="right") - 1
            seq[own], off[own] = firsts[k] + at[own] - starts[k], offsets[k]
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    out = numbered.withColumn("at", place("length", "nth"))
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"]
    return out.select(*cols, *(["ids"] if with_ids else []))
