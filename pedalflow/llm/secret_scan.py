"""Secret scans: base patterns, then sliding-window entropy over token runs (DataFrame functions only).

Base kinds are ``assign``, ``access`` and ``hex``.  The method adds
``entropy16`` (runs of hex digits) and ``entropy64`` (runs of base64 letters):
over each candidate run a window of fixed width slides one character at a time;
the counts per character change by the one that leaves and the one that enters,
and the window's Shannon entropy follows from sum(c * log2 c), kept as scaled
integers so that the result is the same on every machine.  Overlapping windows
at or above the class's threshold become one span.  Candidates that match an
allow-list pattern (plain words, paths, UUIDs, placeholders) are suppressed.

Defined cases: null and empty texts have no spans.  Rows are scanned one by one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, pick

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the whole run after the first AKIA with 20+ characters
HEX = r"[0-9a-f]{24,}"  # a run of lower-case hex digits is matched whole

SPAN = "array<struct<start:int,kind:int,stop:int>>"
SCALE = 1_000_000


@dataclass(frozen=True)
class CharClass:
    """One character class: candidates, window width, entropy threshold in bits."""

    name: str
    pattern: str
    alphabet: str
    window: int
    bits: float


CLASSES = (
    CharClass("entropy16", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{24,}(?![0-9A-Za-z])", "0123456789abcdefABCDEF", 24, 3.0),
    CharClass(
        "entropy64",
        r"(?<![0-9A-Za-z+/_-])[0-9A-Za-z+/_-]{20,}={0,2}",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_=",
        20,
        3.7,
    ),
)
KINDS = ("assign", "access", "hex", *(c.name for c in CLASSES))

#: Candidate runs that are no secrets, matched against the whole run.
ALLOWED = (
    r"[A-Za-z]?[a-z+/_-]*|[A-Z+/_-]*",  # words without digits, joined words
    r"[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}",  # UUIDs
    r".*(?i:example|placeholder|changeme|xxxxxx).*",
    r"[0-9+/_=-]+",  # dates, telephone and serial numbers
    r"(/[A-Za-z0-9_-]+)+/?",  # paths
)


def _scaled(c: int) -> int:
    """c * log2(c) in millionths."""
    return round(c * math.log2(c) * SCALE) if c else 0


def _matches(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans (code points) of all matches: the pieces between matches give their places."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def build(z: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

        def step(acc: Column, e: Column) -> Column:
            start = acc.getField("at") + F.length(e.getField("p"))
            stop = start + F.length(e.getField("m"))
            one = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop")))
            ok = F.lit(True) if keep is None else keep(e.getField("m"))
            return F.struct(
                stop.alias("at"),
                F.when(ok, F.concat(acc.getField("spans"), one)).otherwise(acc.getField("spans")).alias("spans"),
            )

        return F.aggregate(z, zero, step, lambda a: a.getField("spans"))

    zipped = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    return F.when(text.rlike(pattern), build(zipped)).otherwise(F.array().cast(SPAN))


def _long_enough(m: Column) -> Column:
    return F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6


def hot_windows(run: Column, cls: CharClass, kind: int) -> Column:
    """Spans inside ``run``, from 0, of merged windows whose entropy reaches the class's threshold."""
    w, table = cls.window, F.array(*[F.lit(_scaled(c)).cast("long") for c in range(cls.window + 1)])
    # H = log2(w) - sum / w >= bits
    most = math.floor((math.log2(w) - cls.bits) * w * SCALE)
    letters = F.array(*[F.lit(c) for c in cls.alphabet])

    def slide(chars: Column) -> Column:
        first = F.slice(chars, 1, w)
        counts = F.transform(letters, lambda a: F.size(F.filter(first, lambda c: c == a)))
        total = lambda cs: F.aggregate(cs, F.lit(0).cast("long"), lambda s, c: s + F.get(table, c))

        def emit(spans: Column, at: Column, hot: Column) -> Column:
            """Adds window ``at`` to the open span if they overlap, else opens one."""
            last = F.get(spans, F.size(spans) - 1)
            stop = at + w
            here = F.array(F.struct(at.alias("start"), F.lit(kind).alias("kind"), stop.alias("stop")))
            longer = F.array(F.struct(last.getField("start").alias("start"), F.lit(kind).alias("kind"), stop.alias("stop")))
            joined = F.when(
                (F.size(spans) > 0) & (last.getField("stop") >= at),
                F.concat(F.slice(spans, F.lit(1), F.greatest(F.size(spans) - 1, F.lit(0))), longer),
            ).otherwise(F.concat(spans, here))
            return F.when(hot, joined).otherwise(spans)

        def start(cs: Column) -> Column:
            s = total(cs)
            return F.struct(
                cs.alias("counts"), s.alias("sum"), emit(F.array().cast(SPAN), F.lit(0), s <= most).alias("spans")
            )

        def step(acc: Column, i: Column) -> Column:
            out_c, in_c = F.get(chars, i - 1), F.get(chars, i + (w - 1))

            def moved(c: Column) -> Column:
                n_out = F.get(c, F.array_position(letters, out_c).cast("int") - 1)
                n_in = F.get(c, F.array_position(letters, in_c).cast("int") - 1)
                change = F.when(out_c == in_c, F.lit(0).cast("long")).otherwise(
                    F.get(table, n_out - 1) - F.get(table, n_out) + F.get(table, n_in + 1) - F.get(table, n_in)
                )
                new = F.transform(
                    c,
                    lambda x, k: x
                    - (F.get(letters, k) == out_c).cast("int")
                    + (F.get(letters, k) == in_c).cast("int"),
                )
                s = acc.getField("sum") + change
                return F.struct(new.alias("counts"), s.alias("sum"), emit(acc.getField("spans"), i, s <= most).alias("spans"))

            return let(acc.getField("counts"), moved)

        n = F.size(chars)
        steps = F.when(n > w, F.sequence(F.lit(1), n - w)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, let(counts, start), step, lambda a: a.getField("spans"))

    # let: the characters are cut once a run
    return let(F.split(run, ""), lambda c: slide(F.filter(c, lambda x: x != "")))


def _entropy_spans(text: Column, cls: CharClass, kind: int) -> Column:
    allowed = "^(?:" + "|".join(f"(?:{a})" for a in ALLOWED) + ")$"
    runs = _matches(text, cls.pattern, kind, keep=lambda m: ~m.rlike(allowed))

    def inside(r: Column) -> Column:
        run = F.substring(text, r.getField("start") + 1, r.getField("stop") - r.getField("start"))
        return F.transform(
            hot_windows(run, cls, kind),
            lambda s: F.struct(
                (s.getField("start") + r.getField("start")).alias("start"),
                F.lit(kind).alias("kind"),
                (s.getField("stop") + r.getField("start")).alias("stop"),
            ),
        )

    return let(runs, lambda rs: F.when(F.size(rs) == 0, F.array().cast(SPAN)).otherwise(F.flatten(F.transform(rs, inside))))


def render(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s.getField("kind")), s.getField("start"), s.getField("stop"))
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """Every document's spans: doc_id, ``base`` and ``added`` as arrays of (start, kind, stop)."""
    d = pick(docs, "doc_id", "text")
    t = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(_matches(t, ASSIGN, 0, _long_enough), _matches(t, ACCESS, 1), _matches(t, HEX, 2))
    added = F.concat(*[_entropy_spans(t, c, 3 + i) for i, c in enumerate(CLASSES)])
    return d.select("doc_id", base.alias("base"), added.alias("added"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans as text."""
    s = find_secrets(docs)
    count = lambda k: F.size(F.filter("base", lambda x: x.getField("kind") == k)).cast("long")
    return s.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(render(F.col("base")), 256).alias("base_sha256"),
        render(F.concat("base", "added")).alias("spans"),
    )
