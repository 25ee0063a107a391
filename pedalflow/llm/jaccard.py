"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Documents are rows, hashed word n-grams columns.  Rows that are alike are one
class, by a 128-bit digest of the set.  Classes that share too few columns with all
others together to reach the bound with any are left out first (see ``alone``).  The columns are cut into blocks by range
of hash.  Two sets x, y of similarity s or more differ in at most
(|x| + |y|)(1 - s)/(1 + s) n-grams; with one block more than that, at least one
block is the same in both.  So the product is only taken between classes that
agree on a block, and all other pairs lie below the size-derived bound unseen.
The number of blocks steps with the larger set's size; a set is also cut the way
its largest possible partners are.

A key can be shared by a third of all classes, so its members are not all paired with each
other but compared with a pivot (see ``linking``).  For a pair of sets, overlap counts are
accumulated block by block; the pair is discarded as soon as what is left cannot bring the
overlap up to its bound.  Members of large groups that the pivot leaves apart have nearly
everything in common; the product is taken between their differences from a central member instead
(see ``deltas``).

Defined cases: a text of fewer words than n is one n-gram; null texts and texts
without words have the empty set and are linked with nothing; a row without
doc_id has no component and links nothing in ``join``, but is a document like others
in ``keep_one``; rows that repeat a doc_id are linked each for itself.  N-grams are told apart by 64-bit
hashes, classes in links by the first 64 bits of their digest.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.operators.broadcast import bounded_broadcast

from . import alone, deltas, linking
from .common import Scratch, map_arrow, pick, saved
from .linking import FEW, only, small, with_both

#: Lower-cases A-Z and turns the six white space characters into spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
#: Bytes of normalised text hashed at once.
STEP = 1 << 21
#: By how much the sizes of a step grow: wide steps cut sets finer than needed, narrow ones cut more sets twice.
GROWTH = 1.6
_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def _mix(h: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte value; powers of R and of its inverse."""
    per_byte = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_R))
    up, down = np.full(n, _R, np.uint64), np.full(n, pow(_R, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return per_byte, np.cumprod(up), np.cumprod(down)


def shingles(text: str | None, n: int) -> np.ndarray:
    """The distinct word n-grams of the whole text as ascending 64-bit hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < n:
        n = len(words)
    out, at = [], 0
    while at + n <= len(words):
        size, to = 0, at
        while to < len(words) and (size < STEP or to < at + n):  # a stretch of whole words
            size += len(words[to]) + 1
            to += 1
        out.append(_hash(b" ".join(words[at:to]), n))
        at = to - n + 1
    return np.unique(np.concatenate(out))


def _hash(joined: bytes, n: int) -> np.ndarray:
    b = np.frombuffer(joined, np.uint8)
    per_byte, up, down = _powers(1 << max(12, len(b).bit_length()))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(per_byte[b] * up[: len(b)])])
    gaps = np.flatnonzero(b == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(b)]])
    s, e = starts[: len(starts) - n + 1], ends[n - 1 :]
    return _mix((total[e] - total[s]) * down[s])


class Cuts:
    """How many blocks sets are cut into, by size, for a similarity of ``pct`` per cent."""

    def __init__(self, pct: int):
        self.pct = pct
        #: Sizes from low to high are cut into the same number of blocks: (low, high, blocks, spare ones).
        self.steps: list[tuple[int, int, int, int]] = []

    def blocks(self, size: int) -> int:
        """One more than similar sets can differ in n-grams when the larger has ``size``."""
        return 2 * size * (100 - self.pct) // (100 + self.pct) + 1

    def spare(self, size: float, k: int) -> int:
        """How many more blocks than ``k`` a step needs for as many of all to stay empty in a set of ``size``.

        Spare blocks leave more blocks empty in turn.  Sets that have so few n-grams for their
        blocks that no number is enough get the first estimate.
        """
        found = [0]
        while found[-1] <= 2 * k:
            blocks = k + found[-1]
            one = math.exp(-size / blocks)
            empty = blocks * one
            apart = math.sqrt(max(empty * (1 - (1 + size / blocks) * one), 0))
            next_ = math.ceil(empty + 3 * apart) if empty >= 0.05 and k > 3 else 0
            if next_ <= found[-1]:
                return found[-1]
            found.append(next_)
        return found[1]

    def grow(self, size: int) -> None:
        while not self.steps or self.steps[-1][1] < size:
            low = self.steps[-1][1] + 1 if self.steps else 1
            k = self.blocks(low)
            most = k if k < 4 else math.ceil(GROWTH * k)
            high = (most * (100 + self.pct) - 1) // (2 * (100 - self.pct)) if self.pct < 100 else 1 << 60
            high = max(low, high)
            k = self.blocks(high)
            spare = self.spare(low * self.pct / 100, k)
            self.steps.append((low, high, k + spare, spare))

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(step, blocks, spare ones) for a set of ``size``: its own step and those of its larger partners."""
        largest = size * 100 // self.pct
        self.grow(largest)
        return [(i, k, e) for i, (low, high, k, e) in enumerate(self.steps) if high >= size and low <= largest]


def _contents(grams: np.ndarray, k: int) -> np.ndarray:
    """A number for the n-grams in each of ``k`` ranges of hash; 0 for an empty one."""
    mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(grams + np.uint64(_R)))])
    block = ((grams >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    edge = np.searchsorted(block, np.arange(k + 1, dtype=np.uint64))
    return mixed[edge[1:]] - mixed[edge[:-1]]


def block_keys(grams: np.ndarray, cuts: Cuts) -> np.ndarray:
    """Numbers that two similar sets have at least one of in common.

    One per cut and block that is not empty.  Similar sets agree on one block more
    than there are spare ones.  Where no more blocks are empty than are spare, one of
    these is not empty; else the sets may only agree on an empty block, and for each of
    those they are cut once more by another hash and must agree on a block of that too.
    """
    keys = []
    for step, k, spare in cuts.of(len(grams)):
        content = _contents(grams, k)
        place = _mix(np.arange(1, k + 1, dtype=np.uint64) + np.uint64(step << 40))
        empty = content == 0
        keys.append(_mix(content ^ place)[~empty])
        if np.count_nonzero(empty) > spare:
            again = _contents(np.sort(_mix(grams ^ np.uint64(_R))), k)
            again = _mix(again ^ _mix(place))
            keys += [_mix(again + place[i]) for i in np.flatnonzero(empty)]
    return np.concatenate(keys).view(np.int64)


def incidence(docs: DataFrame, n: int, pct: int, without_id: bool = False) -> DataFrame:
    """doc_id, tx, n_shingles, s1 and s2 (digest of the set, null if empty), told, sure and slack (see ``alone``; once a task for each set).

    Rows without doc_id have no digest either, unless ``without_id``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        seen = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                sizes, s1, s2, found = [], [], [], []
                for i, t in zip(b["doc_id"], b["text"], strict=True):
                    g = shingles(t.as_py(), n)
                    sizes.append(len(g))
                    digest = xxhash.xxh3_128_digest(g.tobytes()) if len(g) and (without_id or i.is_valid) else None
                    halves = np.frombuffer(digest, np.int64).tolist() if digest else [None, None]
                    s1.append(halves[0])
                    s2.append(halves[1])
                    found.append(alone.told(g, pct) if digest and digest not in seen else (None, None, None))
                    if len(seen) > 200_000:  # a repeat only costs rows
                        seen.clear()
                    if digest:
                        seen.add(digest)
                told, sure, slack = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        b["doc_id"],
                        b["tx"],
                        pa.array(sizes, pa.int64()),
                        pa.array(s1, pa.int64()),
                        pa.array(s2, pa.int64()),
                        pa.array(told, pa.binary()),
                        pa.array(sure, pa.int64()),
                        pa.array(slack, pa.int64()),
                    ],
                    names=["doc_id", "tx", "n_shingles", "s1", "s2", "told", "sure", "slack"],
                )

    schema = f"doc_id {kind}, tx long, n_shingles long, s1 long, s2 long, told binary, sure long, slack long"
    return map_arrow(docs, run, schema)


def _keyed(batches: Iterator[pa.RecordBatch], pct: int) -> Iterator[pa.RecordBatch]:
    """id, keys of the sets (id, grams)."""
    cuts = Cuts(pct)
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            b = whole.slice(at, 512)
            keys = [block_keys(np.asarray(g.values).view(np.uint64), cuts) for g in b["grams"]]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(keys, pa.list_(pa.int64()))], names=["id", "keys"])


def overlap(x: np.ndarray, y: np.ndarray, least: int, blocks: int = 16) -> int | None:
    """How many n-grams two ascending sets share, counted block by block; None once it must stay under ``least``."""
    if min(len(x), len(y)) < least:
        return None
    edges = np.arange(1, blocks, dtype=np.uint64) * np.uint64(2**64 // blocks)
    ex = [0, *np.searchsorted(x, edges).tolist(), len(x)]
    ey = [0, *np.searchsorted(y, edges).tolist(), len(y)]
    shared = 0
    for i in range(blocks):
        own, other = x[ex[i] : ex[i + 1]], y[ey[i] : ey[i + 1]]
        if len(own) and len(other):
            at = np.searchsorted(other, own)
            shared += int((other[np.minimum(at, len(other) - 1)] == own).sum())
        if shared + min(len(x) - ex[i + 1], len(y) - ey[i + 1]) < least:
            return None
    return shared


def _compared(batches: Iterator[pa.RecordBatch], pct: int) -> Iterator[pa.RecordBatch]:
    """(a, b) of the pairs that are linked."""
    for batch in batches:
        close = []
        for x, y in zip(batch["x"], batch["y"], strict=True):
            x, y = (np.asarray(v.values).view(np.uint64) for v in (x, y))
            close.append(overlap(x, y, -(-pct * (len(x) + len(y)) // (100 + pct))) is not None)
        yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(close)), batch["b"].filter(pa.array(close))], names=["a", "b"])


def _place() -> Column:
    """Where a row stands: rows without doc_id come last, rows that repeat a doc_id by text."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tx")


def linked(rows: DataFrame, sets_of: Callable[[DataFrame, Scratch], DataFrame], pct: int, few: int = FEW) -> DataFrame | None:
    """(id, comp) of all sets that are linked: the components of all links among ids that share a key; saved.

    ``rows`` has (key, id) and may repeat; ``sets_of`` gives (id, grams) of saved ids.
    """
    sets: list[DataFrame] = []

    def prepare(ids: DataFrame, work: Scratch):
        sets.append(sets_of(ids, work))
        return lambda pairs: map_arrow(with_both(pairs, sets[0], "grams"), lambda b: _compared(b, pct), "a long, b long")

    def last(large: DataFrame, comps: DataFrame, compare, work: Scratch) -> DataFrame:
        of = work.saved(large.select(F.col("p").alias("a"), F.col("id").alias("b")).filter("a != b").distinct(), "pivots")
        apart = deltas.from_pivots(of, sets[0], work)
        apart = deltas.recentred(apart, work)
        # links joins only what the components leave apart, and takes those of the pivots as known
        near = work.saved(deltas.close_to_pivot(apart, pct), "near")
        comps = linking.components(near.union(comps.select("comp", "id")), work)
        return near.union(deltas.links(apart, comps, pct, work))

    return linking.linked(rows, prepare, last, few)


def _not_alone(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """id (s1) of the saved ``sets`` that may have a similar one; ``classes``: s1, n of all."""
    copies = classes.filter("n > 1").select(F.col("s1").alias("id"))
    copies = F.broadcast(copies) if small(copies) else copies
    d = sets.filter("told IS NOT NULL").select(F.col("s1").alias("id"), "told", "sure", "slack")
    # sorted, so that a task that runs again makes the same batches
    one = d.join(copies, "id", "left_semi").dropDuplicates(["id"]).sortWithinPartitions("id")
    once = d.join(copies, "id", "left_anti").union(one)
    return alone.others(once, d.agg(F.sum("sure")).first()[0] or 0)


def _groups(docs: DataFrame, n: int, pct: int, without_id: bool = False) -> tuple[DataFrame, DataFrame]:
    """The incidence of ``docs``, and (s1, first): the first place of each set's group, for sets that are not alone; saved."""
    d = pick(docs, "doc_id", "text").withColumn("tx", F.xxhash64("text"))
    held = Scratch(docs.sparkSession, "sets")
    told = held.saved(incidence(d, n, pct, without_id), "incidence")
    inc = saved(told.select("doc_id", "tx", "n_shingles", "s1", "s2"), "incidence")
    ids = inc.filter("s1 IS NOT NULL").groupBy("s1", "s2").agg(F.min(_place()).alias("rep"), F.count("*").alias("n"))
    classes = saved(ids.groupBy("s1").agg(F.min("rep").alias("rep"), F.sum("n").alias("n")), "classes")

    def sets_of(ids: DataFrame, work: Scratch) -> DataFrame:
        """id, grams (ascending as unsigned numbers) of the saved ``ids``."""
        wanted = classes.join(F.broadcast(ids) if small(ids) else ids, classes["s1"] == ids["id"], "left_semi")
        of = work.saved(wanted.select(F.col("rep.tx").alias("tx")).distinct(), "wanted")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import xxhash

            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    found = [shingles(t.as_py(), n) for t in whole.slice(at, 512)["text"]]
                    s1 = [int(np.frombuffer(xxhash.xxh3_128_digest(g.tobytes()), np.int64)[0]) for g in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s1, pa.int64()), pa.array([g.view(np.int64) for g in found], pa.list_(pa.int64()))],
                        names=["id", "grams"],
                    )

        grams = map_arrow(only(d, of, "tx").select("text"), run, "id long, grams array<long>")
        return work.saved(grams.dropDuplicates(["id"]), "grams")

    near = saved(_not_alone(told, classes), "near")
    held.remove()
    held = Scratch(docs.sparkSession, "sets")
    grams = sets_of(near, held)
    rows = map_arrow(grams, lambda b: _keyed(b, pct), "id long, keys array<long>")
    rows = rows.select(F.explode("keys").alias("key"), "id")
    comps = linked(rows, lambda ids, work: work.saved(only(grams, ids, "id"), "grams"), pct)
    held.remove()
    known = classes.select("s1", "rep", "n")
    if comps is not None:
        known = known.join(comps.withColumnRenamed("id", "s1"), "s1", "left")
        first = known.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("rep").alias("first"))
        known = known.join(first, "comp", "left").withColumn("rep", F.coalesce("first", "rep"))
        known = known.filter("n > 1 OR comp IS NOT NULL")
    else:
        known = known.filter("n > 1")
    return inc, saved(known.select("s1", F.col("rep").alias("first")), "first")


def join(docs: DataFrame, n: int = 5, pct: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: linked at ``pct`` per cent of word ``n``-grams."""
    inc, known = _groups(docs, n, pct)
    first = known.select("s1", F.col("first.doc_id").alias("first"))
    out = inc.select("doc_id", "n_shingles", "s1").join(first, "s1", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, pct: int = 80) -> DataFrame:
    """One row of each group, the first by doc_id and hash of the text; the columns of ``documents``.

    Rows are judged each for itself, so one that is linked with nothing stays whatever
    doc_id it has.  Rows without doc_id are linked too and come last in their group.
    """
    cols = ("doc_id", "text", "lang", "source", "n_chars")
    d = pick(docs, *cols).withColumn("tx", F.xxhash64("text"))
    inc, known = _groups(d, n, pct, without_id=True)
    # rows of one doc_id and text share their set and so their verdict
    rows = inc.select("doc_id", "tx", "s1").join(known, "s1").groupBy("doc_id", "tx")
    marks = rows.agg(F.min("first").alias("first"), F.count("*").alias("n")).withColumn("gone", _place() != F.col("first"))
    marks = marks.filter("gone OR n > 1").select(F.col("doc_id").alias("of"), F.col("tx").alias("of_tx"), "gone")
    marks = saved(marks, "copies")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("tx") == F.col("of_tx"))
    judged = d.join(bounded_broadcast(marks), same, "left")
    kept = judged.filter("gone IS NULL").select(*cols)
    if marks.filter("NOT gone").isEmpty():
        return kept
    # the first row of a group repeats as a whole
    again = judged.filter("NOT gone").groupBy("doc_id", "tx").agg(F.min(F.struct(*cols)).alias("row"))
    return kept.union(again.select("row.*"))
