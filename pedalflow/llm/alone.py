"""Sets that have too many elements to themselves to be like any other set.

A set that reaches a similarity of s with another has s of its elements in common with it, so one
that has more than 1 - s of them to itself is linked with nothing, whatever the others look like.

To find those, each set tells a part of its elements, drawn by their hash, the same for all sets but
for a limit that falls with the set's size: what a set tells below the limit of its largest possible
partner, all its possible partners would tell as well.  Only that counts as its own if nobody else
tells it; the rest is told for others to see.  The told elements travel by range of hash, as three
bytes and the set's place in its batch; what was met twice in a range goes back to the batch.
An element that many sets have travels once a batch.

Elements that fall together by their three bytes only make a set seem less alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import reachable

#: Told elements of a batch at most (but for its last arrow batch), and of a range about.
BATCH, RANGE = 1 << 21, 1 << 20
_DEALT = "part long, batch long, own binary, docs binary, other binary"
_MET = "batch long, docs binary, ids binary, slack binary"


def _limit(size: int, pct: int) -> int:
    """Which elements a set of ``size`` tells: those whose last 16 bits are lower.  Never rises with the size."""
    return min(1 << 16, int((1 << 16) * (1.5 * (100 - pct) / 100 + 0.8 / math.sqrt(size))))


def told(elements: np.ndarray, pct: int) -> tuple[bytes, int, int]:
    """The first 40 bits of the 64-bit elements that a set tells, how many of them (they come first)
    can count as its own, and how many of those others may have before the set stops being alone."""
    size = len(elements)
    drawn = elements & np.uint64(0xFFFF)
    own = drawn < _limit(size * 100 // pct, pct)
    rest = (drawn < _limit(size, pct)) & ~own
    values = np.concatenate([elements[own], elements[rest]]) >> np.uint64(24)
    n = int(np.count_nonzero(own))
    return _bytes(values, 5), n, n - (size - -(-pct * size // 100) + 1)


def _bytes(numbers: np.ndarray, width: int) -> bytes:
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _numbers(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _steps(ascending: np.ndarray) -> bytes:
    """Ascending numbers as the steps between them, a byte each; 255 is added to the next byte."""
    step = np.diff(ascending, prepend=0)
    ends = np.cumsum(step // 255 + 1)
    out = np.full(ends[-1] if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = step % 255
    return out.tobytes()


def _places(steps: bytes) -> np.ndarray:
    step = np.frombuffer(steps, np.uint8)
    return np.cumsum(step, dtype=np.int64)[step != 255]


def _packed(held: list[pa.RecordBatch], batch: int, bits: int) -> pa.RecordBatch:
    """A row for each range with what the sets tell in it, and one with the sets' ids and how much they may share."""
    whole = pa.Table.from_batches(held)
    ids, slack, sure = (whole[c].to_numpy().astype(kind) for c, kind in (("id", "<i8"), ("slack", "<i8"), ("sure", "<i8")))
    raw = whole["told"].to_pylist()
    n = np.array([len(x) // 5 for x in raw], np.int64)
    doc = np.repeat(np.arange(len(ids)), n)
    own = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) < np.repeat(sure, n)
    place = _numbers(b"".join(raw), 5) >> np.uint64(16 - bits)  # range, then 24 bits
    order = np.argsort(place, kind="stable")
    same = np.diff(place[order]) == 0
    again = np.concatenate([[False], same])
    twice = again | np.concatenate([same, [False]])
    met = order[twice[: len(order)]]
    slack -= np.bincount(doc[met[own[met]]], minlength=len(ids))
    once, alone = order[~again[: len(order)]], np.zeros(len(doc), bool)
    alone[order[~twice[: len(order)]]] = True
    own &= alone & (slack >= 0)[doc]
    edges = np.arange((1 << bits) + 1)
    sides = []
    for at in (np.sort(once[own[once]]), once[~own[once]]):  # places of a batch in ascending order
        part = (place[at] >> np.uint64(24)).astype(np.uint16)
        at = at[np.argsort(part, kind="stable")]
        sides.append((at, place[at] & np.uint64(0xFFFFFF), np.searchsorted(np.sort(part), edges)))
    (at, mine, e), (_, others, f) = sides
    rows = [
        (p, batch, _bytes(mine[e[p] : e[p + 1]], 3), _steps(doc[at[e[p] : e[p + 1]]]), _bytes(others[f[p] : f[p + 1]], 3))
        for p in np.flatnonzero((np.diff(e) > 0) | (np.diff(f) > 0)).tolist()
    ]
    rows.append((-1 - batch, batch, ids.tobytes(), None, slack.tobytes()))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "batch", "own", "docs", "other"]
    )


def _dealt(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    batch = TaskContext.get().partitionId() << 32
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b["told"].nbytes
        if size >= 5 * BATCH:
            yield _packed(held, batch, bits)
            held, size, batch = [], 0, batch + 1
    if sum(b.num_rows for b in held):
        yield _packed(held, batch, bits)


def _met(key: tuple, dealt: pa.Table) -> pa.Table:
    """For each batch the places of the sets whose own elements others have as well, once an element."""
    if key[0].as_py() < 0:
        return dealt.select(["batch", "docs", "own", "other"]).rename_columns(["batch", "docs", "ids", "slack"])
    own = [_numbers(x.as_py(), 3) for x in dealt["own"]]
    every = np.sort(np.concatenate([*own, *(_numbers(x.as_py(), 3) for x in dealt["other"])]))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    whole = np.concatenate([np.empty(0, np.uint64), *own])
    at = np.searchsorted(twice, whole)
    hit = np.append(twice, np.uint64(1 << 24))[at] == whole  # the places have 24 bits
    ends = np.cumsum([len(x) for x in own])
    docs = [_steps(_places(d.as_py())[h]) for h, d in zip(np.split(hit, ends[:-1]), dealt["docs"], strict=True)]
    none = pa.nulls(len(docs), pa.binary())
    return pa.table([dealt["batch"], pa.array(docs, pa.binary()), none, none], names=["batch", "docs", "ids", "slack"])


def _open(key: tuple, met: pa.Table) -> pa.Table:
    """The ids of a batch's sets that share more than they may."""
    ids, slack = (np.frombuffer(met[c].drop_null()[0].as_py(), "<i8") for c in ("ids", "slack"))
    places = [_places(d) for d in met["docs"].to_pylist() if d is not None]
    shared = np.bincount(np.concatenate([np.empty(0, np.int64), *places]), minlength=len(ids))
    return pa.table([pa.array(ids[shared > slack], pa.int64())], names=["id"])


def others(sets: DataFrame, elements: int) -> DataFrame:
    """The ids of the sets that are not known to be alone; ``elements``: about how many all of them tell.

    ``sets``: id, and told, sure, slack as ``told`` gives them; saved, one row an id (repeats only seem less alone).
    """
    reachable(sets.sparkSession)
    bits = min(16, max(0, math.ceil(math.log2(max(1, elements) / RANGE))))
    dealt = sets.select("id", "told", "sure", "slack").mapInArrow(lambda b: _dealt(b, bits), _DEALT)
    met = dealt.groupBy("part").applyInArrow(_met, _MET)
    return met.groupBy("batch").applyInArrow(_open, "id long")
