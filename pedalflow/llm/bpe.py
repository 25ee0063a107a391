"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

A merge never depends on what stands after it is done, so the encoding of a piece's
prefix ends with exactly one token, and what is before that token is the encoding of a
shorter prefix.  ``last[i]`` holds that token for the first i bytes.  A token that ends
at byte i is the one if its bytes encode to itself alone and it may follow the token
before it: merging the bytes of the two never merges across the border.  That gives
the ids in time linear in the bytes, also for a run of a million equal letters.

The table makes changes cheap.  Appended bytes only add entries.  After a change in the
middle, entries up to it stay, and the new ones are the old ones again as soon as as many
in a row agree as the longest token has bytes.  ``Encoded`` does the same for a whole
text, whose pieces (matches of a pattern) are encoded one by one: pieces that end before
a change stay, and those after it stay from the first common border on.

A piece that is itself in the vocabulary is that token, as in the tiktoken library.

Defined cases: a null text is an empty one, which has no tokens; a text of any length is
cut in stretches at borders of pieces; rows stay rows, so repeated rows and rows without
doc_id are encoded each for itself; an empty table gives an empty result; extra columns,
whatever their names, are left behind.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_arrow, pick

#: Code points that are cut into pieces at once.
STEP = 1 << 20
#: Entries of a cache, of about 200 bytes, before it is emptied.
CACHED = 1_000_000
#: Tokens of so many bytes or more are looked for by their last ones.
SUFFIX = 4
SHORTER = tuple(range(SUFFIX - 1, 0, -1))
#: Longer pieces are encoded anew each time.
CACHED_CHARS = 64


class Vocabulary:
    """Tokens by rank, as (bytes, rank) lines of a tiktoken file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        # the lengths of the tokens that end in the same SUFFIX bytes, and of shorter ones, the longest first
        ending: dict[bytes, set[int]] = {}
        for t in ranks:
            if len(t) >= SUFFIX:
                ending.setdefault(t[-SUFFIX:], set()).add(len(t))
        self.ending = {end: (*sorted(found, reverse=True), *SHORTER) for end, found in ending.items()}
        self._halves: dict[bytes, list[bytes]] = {}
        self._grown: dict[bytes, bool] = {}
        self._pairs: dict[tuple[bytes, bytes], bool] = {}

    def merged(self, piece: bytes, least: int = 1) -> list[bytes]:
        """The parts of ``piece`` after all merges, the lowest rank first, the leftmost of equals; ``least`` parts stay."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > least:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def sound(self, token: bytes) -> bool:
        """Whether the token's own bytes merge into it."""
        return len(token) == 1 or len(self.halves(token)) == 2

    def halves(self, token: bytes) -> list[bytes]:
        """The two parts of the token's last merge (more if its bytes don't merge into it)."""
        found = self._halves.get(token)
        if found is None:
            found = self._halves[token] = self.merged(token, 2)
        return found

    def grown(self, token: bytes) -> bool:
        """Whether the token's merges come in the order of their ranks, as in any trained vocabulary."""
        found = self._grown.get(token)
        if found is None:
            found = len(token) == 1 or self.sound(token) and all(
                len(h) == 1 or h in self.ranks and self.ranks[h] < self.ranks[token] and self.grown(h) for h in self.halves(token)
            )
            self._grown[token] = found
        return found

    def follows(self, token: bytes, before: bytes) -> bool:
        """Whether ``before`` and ``token`` stay apart when their bytes are merged together."""
        pair = before, token
        found = self._pairs.get(pair)
        if found is None:
            if len(self._pairs) > CACHED:
                self._pairs.clear()
            if self.grown(before) and self.grown(token):
                found = self._apart(before, token)
            else:
                found = self.merged(before + token) == [before, token]
            self._pairs[pair] = found
        return found

    def _apart(self, left: bytes, right: bytes) -> bool:
        """Undoes the merges of both tokens, the latest first; at no time may a merge over the border have been due.

        Of two merges of one rank the left one comes first.
        """
        ranks = self.ranks
        left_ends = right_ends = 1 << 60  # ranks of the merges that take the parts at the border away
        while True:
            across = ranks.get(left + right, 1 << 60)
            if across < left_ends and across <= right_ends and across < 1 << 60:
                return False
            made_left = ranks[left] if len(left) > 1 else -1
            made_right = ranks[right] if len(right) > 1 else -1
            if made_left > made_right:
                left, left_ends = self.halves(left)[1], made_left
            elif made_right >= 0:
                right, right_ends = self.halves(right)[0], made_right
            else:
                return True

    def extend(self, piece: bytes, last: list[int], end: int) -> None:
        """Appends the entries of ``last`` (lengths of last tokens; its first stands for no bytes) up to ``end`` bytes."""
        ranks, known, ending = self.ranks, self._pairs, self.ending
        for i in range(len(last), end + 1):
            for length in ending.get(piece[i - SUFFIX : i], SHORTER) if i >= SUFFIX else SHORTER:
                at = i - length
                if at < 0:
                    continue
                token = piece[at:i]
                if token not in ranks:
                    continue
                if at:
                    before = piece[at - last[at] : at]
                    stays = known.get((before, token))
                    if self.follows(token, before) if stays is None else stays:
                        break
                elif self.sound(token):
                    break
            else:
                raise ValueError(f"no token ends the bytes {piece[max(0, i - self.longest):i]!r}")
            last.append(i - at)

    def prefixes(self, piece: bytes) -> list[int]:
        """The length of the last token of every prefix of ``piece``, 0 for the empty one."""
        last = [0]
        self.extend(piece, last, len(piece))
        return last

    def changed(self, piece: bytes, last: list[int], start: int, stop: int, by: bytes) -> tuple[bytes, list[int]]:
        """The piece with bytes ``start`` to ``stop`` replaced, and its table from the old one."""
        new = piece[:start] + by + piece[stop:]
        found, shift = last[: start + 1], len(by) - (stop - start)
        same = 0
        while len(found) <= len(new):
            i = len(found)
            self.extend(new, found, i)
            # a prefix is told by the last tokens of the ``longest`` ones before it
            inside = i - shift - found[i] >= stop
            same = same + 1 if inside and last[i - shift] == found[i] else 0
            if same >= self.longest:
                found += last[i - shift + 1 :]
                break
        return new, found

    def ids(self, piece: bytes, last: list[int]) -> list[int]:
        """The token ids that the table tells, from the end back."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        found, i = [], len(piece)
        while i:
            found.append(self.ranks[piece[i - last[i] : i]])
            i -= last[i]
        return found[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.ids(piece, self.prefixes(piece))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Pieces(dict):
    """The ids of a piece (str) as little-endian unsigned 32-bit integers, remembered for short pieces."""

    def __init__(self, words: Vocabulary):
        super().__init__()
        self.words = words

    def __missing__(self, piece: str) -> bytes:
        return _packed(self.words.encode(piece.encode("utf-8", "surrogatepass")))

    def learn(self, found: Iterable[list[str]]) -> None:
        """Encodes the short pieces that are new, in order: each goes on from the table of the one before where they part."""
        new: set[str] = set()
        for part in found:
            new.update(part)
        new = {p for p in new if p not in self}  # by the new ones: all that is known may be a million
        if len(self) + len(new) > CACHED:
            self.clear()
        words, ranks, before, last = self.words, self.words.ranks, b"", [0]
        for raw, piece in sorted((p.encode("utf-8", "surrogatepass"), p) for p in new if len(p) <= CACHED_CHARS):
            whole = ranks.get(raw)
            if whole is not None:
                self[piece] = _packed([whole])
                continue
            same, most = 0, min(len(raw), len(before))
            while same < most and raw[same] == before[same]:
                same += 1
            del last[same + 1 :]
            words.extend(raw, last, len(raw))
            before = raw
            self[piece] = _packed(words.ids(raw, last))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.cache
def vocabulary(path: str) -> tuple[Vocabulary, Pieces]:
    """The vocabulary file (a token in base64 and its rank a line), once a process."""
    with open(path, "rb") as f:
        words = Vocabulary({base64.b64decode(t): int(r) for t, r in map(bytes.split, f) if t})
    return words, Pieces(words)


@functools.cache
def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def pieces(text: str, pattern: str, step: int = STEP) -> Iterator[list[str]]:
    """The matches of ``pattern`` in the text, which they cover, stretch by stretch.

    Near the end of a stretch a match could be another with more text, so a stretch is
    cut before the first one that may have looked there.
    """
    find, at, size = _compiled(pattern).findall, 0, step
    while at < len(text):
        end = min(len(text), at + size)
        found = find(text, at, end)
        if end < len(text):
            stop = end
            while found and not _settled(stop - len(found[-1]), stop, end):
                stop -= len(found.pop())
            if not found:  # one match reaches over the whole stretch
                size *= 2
                continue
            at, size = stop, step
        else:
            at = end
        yield found


def _settled(start: int, end: int, known: int) -> bool:
    """Whether a match from start to end has only looked at text before ``known``.

    The contractions look three characters ahead, all else one beyond the match, and
    one more after white space.
    """
    return max(start + 3, end + 2) <= known


class Encoded:
    """A text with its pieces and their ids; changes encode no more than what they touch."""

    def __init__(self, text: str, words: Vocabulary, pattern: str):
        self.words, self.pattern, self.text = words, pattern, text
        self.pieces = list(chain.from_iterable(pieces(text, pattern)))
        self.tables: list[list[int] | None] = [None] * len(self.pieces)
        self.own = [words.encode(p.encode("utf-8", "surrogatepass")) for p in self.pieces]

    @property
    def ids(self) -> list[int]:
        return list(chain.from_iterable(self.own))

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, by: str) -> int:
        """Replaces the code points from ``start`` to ``stop``; returns how many pieces were encoded anew."""
        new = self.text[:start] + by + self.text[stop:]
        shift = len(by) - (stop - start)
        keep = at = 0
        while keep < len(self.pieces) and _settled(at, at + len(self.pieces[keep]), start):
            at += len(self.pieces[keep])
            keep += 1
        borders, place = {}, at  # old borders after the change, by their place in the new text
        for i in range(keep, len(self.pieces) + 1):
            if place >= stop:
                borders[place + shift] = i
            if i < len(self.pieces):
                place += len(self.pieces[i])
        found: list[str] = []
        match = _compiled(self.pattern).match
        rest = len(self.pieces)
        while at < len(new):
            if at in borders and at >= start + len(by):
                rest = borders[at]
                break
            piece = match(new, at).group()
            found.append(piece)
            at += len(piece)
        old = list(range(keep, rest))
        own, tables = [], []
        for i, piece in enumerate(found):
            ids, table = self._encoded(piece, old[i] if len(found) == len(old) else None)
            own.append(ids)
            tables.append(table)
        self.pieces[keep:rest], self.own[keep:rest], self.tables[keep:rest] = found, own, tables
        self.text = new
        return len(found)

    def _encoded(self, piece: str, before: int | None) -> tuple[list[int], list[int]]:
        """A piece's ids and table, from the table of the piece it replaces where there is one."""
        raw = piece.encode("utf-8", "surrogatepass")
        if before is None:
            table = self.words.prefixes(raw)
            return self.words.ids(raw, table), table
        old = self.pieces[before].encode("utf-8", "surrogatepass")
        table = self.tables[before] or self.words.prefixes(old)
        start = next((i for i, (x, y) in enumerate(zip(old, raw, strict=False)) if x != y), min(len(old), len(raw)))
        most = min(len(old), len(raw)) - start
        end = next((i for i in range(most) if old[-1 - i] != raw[-1 - i]), most)
        raw, table = self.words.changed(old, table, start, len(old) - end, raw[start : len(raw) - end])
        return self.words.ids(raw, table), table


def _joined(found: Iterable[list[str]], known: Pieces) -> np.ndarray:
    return np.frombuffer(b"".join(map(known.__getitem__, chain.from_iterable(found))), "<u4")


def token_ids(texts: list[str], path: str, pattern: str) -> Iterator[np.ndarray]:
    """The ids of each whole text, as little-endian unsigned 32-bit integers."""
    known = vocabulary(path)[1]
    at = 0
    while at < len(texts):
        held, size = [], 0
        while at < len(texts) and len(texts[at]) + size <= STEP:  # short texts are learned together
            held.append(list(pieces(texts[at], pattern)))
            size += len(texts[at])
            at += 1
        if not held:  # a long one, stretch by stretch
            parts = []
            for found in pieces(texts[at], pattern):
                known.learn([found])
                parts.append(_joined([found], known))
            at += 1
            yield np.concatenate(parts)
            continue
        known.learn(chain.from_iterable(held))
        for found in held:
            yield _joined(found, known)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            b = whole.slice(at, 256)
            yield b["doc_id"], [t or "" for t in b["text"].to_pylist()]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids of every document."""
    d = pick(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, texts in _texts(batches):
            ids = list(token_ids(texts, path, pattern))
            ends = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]), pa.int32())
            ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, "<u4"), *ids]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([doc_id, ids], names=["doc_id", "ids"])

    return map_arrow(d, run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text (binary: the bytes of any ids) of rows with doc_id and ids."""
    d = pick(encoded, "doc_id", "ids")
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)[0]
        for b in batches:
            found = [words.decode(i or []) for i in b["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(found, pa.binary())], names=["doc_id", "text"])

    return map_arrow(d, run, f"doc_id {kind}, text binary")


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded, its ids decoded again, in one pass."""
    d = pick(docs, "doc_id", "text")
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)[0]
        for doc_id, texts in _texts(batches):
            n, of_ids, of_bytes = [], [], []
            for ids in token_ids(texts, path, pattern):
                n.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                back = hashlib.sha256()
                for at in range(0, len(ids), STEP):
                    back.update(words.decode(ids[at : at + STEP].tolist()))
                of_bytes.append(back.hexdigest())
            columns = [doc_id, pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(d, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
