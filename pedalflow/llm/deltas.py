"""Pairs of similar sets inside one large group, by their differences from a pivot.

The sets of a group (near copies of one text) have nearly everything in common, so an
index of their elements would hold long lists that say nothing.  What tells them apart is
small: with D(z) the elements that are in z or in the pivot p but not in both,

    |z1 xor z2| = |D(z1)| + |D(z2)| - 2 |D(z1) and D(z2)|.

The incidence matrix of the differences is multiplied with itself, block by block: a block
holds the sets of one pivot and one element.  Let A = 100 - pct and B = 100 + pct; sets are
linked if |z1 xor z2| B <= A (|z1| + |z2|).  Sets close to the pivot are linked by
it, so of any other pair that matters one set, z1, has G = |D(z1)| B - A (|z1| + |p|) > 0.
With |z2| <= |p| + |D(z2)|, a link needs an overlap of more than pct |D(z2)| / B and at
least G / 200.  So a set only enters the product with its rarest elements, as many as leave
less than that overlap to all others, and what occurs in one set, or in sets of one component
alone, counts as rarest of all without ever being joined.  Overlap counts are accumulated
over the blocks; a pair is discarded if what its sets have left after their last common element
cannot bring the count up to its bound.  This is exact for sets at any distance from the pivot.

How much is joined depends on the pivot: what it alone has, or lacks, is in the differences of
all others, who then seem to have it in common.  So the first pivot, any member, only serves to
find a better one (``recentred``): the member nearest to what more than half of the group has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.operators.broadcast import bounded_broadcast, is_bounded

from .common import Scratch, map_arrow
from .linking import with_both


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """p, z, n_p, n_z, delta of (a, b, x, y) with the pivot as a."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            b = whole.slice(at, 256)
            n_p, n_z, delta = [], [], []
            for x, y in zip(b["x"], b["y"], strict=True):
                x, y = np.asarray(x.values), np.asarray(y.values)
                n_p.append(len(x))
                n_z.append(len(y))
                delta.append(np.setxor1d(x, y, assume_unique=True))
            columns = [b["a"], b["b"], pa.array(n_p, pa.int64()), pa.array(n_z, pa.int64()), pa.array(delta, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["p", "z", "n_p", "n_z", "delta"])


def from_pivots(pairs: DataFrame, sets: DataFrame, work: Scratch) -> DataFrame:
    """p, z, n_p, n_z, delta of saved pairs (a, b) with the pivot as a, for sets (id, grams); saved."""
    schema = "p long, z long, n_p long, n_z long, delta array<long>"
    return work.saved(map_arrow(with_both(pairs, sets, "grams"), _differences, schema), "deltas")


def recentred(deltas: DataFrame, work: Scratch) -> DataFrame:
    """The same groups around their most central member: rows like ``deltas``, one per (p, z); saved.

    With M the elements that are in the differences of more than half of a group, the new pivot
    is the member with the smallest |D(z) xor M|; the old one, with D empty, is a member like all
    others.  Differences from the new pivot are D(z) xor D(pivot).  Groups that find the same one are merged.
    """
    own = deltas.select("p", "z", "n_z", "delta")
    old = deltas.select("p", F.col("p").alias("z"), F.col("n_p").alias("n_z"), F.array().cast("array<long>").alias("delta"))
    each = own.select("p", "z", F.explode("delta").alias("e"))
    sizes = own.groupBy("p").agg((F.count("*") + 1).alias("n"))
    common = each.groupBy("p", "e").agg(F.count("*").alias("df")).join(sizes, "p").filter("2 * df > n")
    common = work.saved(common.select("p", "e"), "common")
    met = each.join(bounded_broadcast(common), ["p", "e"]).groupBy("p", "z").agg(F.count("*").alias("met"))
    members = own.select("p", "z", F.size("delta").alias("m")).union(old.select("p", "z", F.lit(0)).distinct())
    # |M| is the same for all members of a group
    off = members.join(met, ["p", "z"], "left").withColumn("off", F.expr("m - 2 * coalesce(met, 0)"))
    best = work.saved(off.groupBy("p").agg(F.min(F.struct("off", "z")).alias("c")).select("p", F.col("c.z").alias("c")), "centres")
    every = own.union(old.dropDuplicates(["p"]))
    centres = every.join(best, "p").filter("z = c").select("p", "c", F.col("n_z").alias("n_c"), F.col("delta").alias("d"))
    centres = work.saved(centres, "centres")
    few = is_bounded(centres.withColumn("d", F.array_join(F.col("d").cast("array<string>"), " ")))
    apart = F.array_union(F.array_except("delta", "d"), F.array_except("d", "delta"))
    moved = every.join(F.broadcast(centres) if few else centres, "p").filter("z != c")
    moved = moved.select(F.col("c").alias("p"), "z", F.col("n_c").alias("n_p"), "n_z", apart.alias("delta"))
    return work.saved(moved.dropDuplicates(["p", "z"]), "recentred")


def close_to_pivot(deltas: DataFrame, pct: int) -> DataFrame:
    """(a, b): pivots and the sets that are linked with them."""
    near = F.size("delta") * (100 + pct) <= (100 - pct) * (F.col("n_z") + F.col("n_p"))
    return deltas.filter(near).select(F.col("p").alias("a"), F.col("z").alias("b"))


def _kept(d: DataFrame, work: Scratch) -> DataFrame:
    """(p, z, own): the elements (df, e) that sets of other components in the group have too, rarest first."""
    each = d.select("p", "z", "comp", F.explode("delta").alias("e"))
    shared = each.groupBy("p", "e").agg(F.count("*").alias("df"), F.min("comp").alias("x"), F.max("comp").alias("y"))
    shared = work.saved(shared.filter("x != y").select("p", "e", "df"), "shared")
    return each.join(shared, ["p", "e"]).groupBy("p", "z").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("own"))


def links(deltas: DataFrame, comps: DataFrame, pct: int, work: Scratch) -> DataFrame:
    """(a, b): linked sets of different components that have a pivot in common; saved.

    ``deltas``: p, z, n_p, n_z (sizes), delta (array<long>); saved, one row per (p, z).
    ``comps``: id, comp of the sets that are linked already.
    """
    a, b = 100 - pct, 100 + pct
    known = comps.select(F.col("id").alias("z"), "comp")
    d = deltas.withColumn("m", F.size("delta")).join(known, "z", "left").withColumn("comp", F.coalesce("comp", "z"))
    kept = _kept(d, work)
    excess = F.col("m") * b - a * (F.col("n_z") + F.col("n_p"))
    rare = F.col("m") - F.size("own")  # elements that rank before all kept ones
    as_any = F.col("m") - F.floor(pct * F.col("m") / b)
    as_far = F.when(excess > 0, F.col("m") - F.ceil(excess / 200) + 1).otherwise(0)
    held = d.select("p", "z", "comp", "m", "n_z", "n_p").join(kept, ["p", "z"])
    entries = held.select(
        "p", "z", "comp", "m", "n_z", (as_any - rare).alias("any"), (as_far - rare).alias("far"), rare.alias("rare"),
        (excess > 0).alias("is_far"), F.posexplode("own").alias("i", "own"),
    ).withColumn("rank", F.col("rare") + F.col("i") + 1).withColumn("e", F.col("own.e")).drop("own", "rare")
    entries = work.saved(entries.filter(F.col("i") < F.greatest("any", "far")), "entries")

    def side(k: int) -> list:
        of = {"z": f"z{k}", "comp": f"c{k}", "m": f"m{k}", "n_z": f"n{k}", "rank": f"r{k}", "i": f"i{k}"}
        return ["p", "e", *[F.col(c).alias(name) for c, name in of.items()]]

    one = entries.filter("i < far").select(*side(1))
    two = entries.filter("i < any").select(*side(2), F.col("is_far").alias("far2"))
    left = F.least(F.col("m1") - F.col("r1"), F.col("m2") - F.col("r2"))
    least = (F.col("m1") + F.col("m2")) * b - a * (F.col("n1") + F.col("n2"))
    # at any common element: what both have before it, in other sets too, and after it
    reach = 2 * b * (F.least("i1", "i2") + 1 + left) >= least
    met = one.join(two, ["p", "e"]).filter(F.expr("c1 != c2 AND (z1 < z2 OR NOT far2)") & reach)
    # what was met, and what both have left after the last of it, must be able to reach the overlap of a link
    met = met.groupBy("p", "z1", "z2").agg(
        F.count("*").alias("shared"), F.max("r1").alias("r1"), F.max("r2").alias("r2"),
        *[F.first(c).alias(c) for c in ("m1", "m2", "n1", "n2")],
    )
    met = met.filter(2 * b * (F.col("shared") + left) >= least)
    met = met.groupBy(F.least("z1", "z2").alias("a"), F.greatest("z1", "z2").alias("b")).agg(F.min("p").alias("p"))
    met = work.saved(met, "candidates")
    of = lambda name: deltas.select("p", F.col("z").alias(name), F.col("n_z").alias(f"n_{name}"), F.col("delta").alias(f"d_{name}"))
    both = met.join(of("a"), ["p", "a"]).join(of("b"), ["p", "b"])
    apart = F.size("d_a") + F.size("d_b") - 2 * F.size(F.array_intersect("d_a", "d_b"))
    return work.saved(both.filter(apart * b <= a * (F.col("n_a") + F.col("n_b"))).select("a", "b").distinct(), "found")


def within(deltas: DataFrame, comps: DataFrame, limit: Callable[[Column], Column], work: Scratch) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of different components that may have |a xor b| + ||a| - |b|| <= ``limit`` of both sizes; saved.

    A pair needs an overlap of (|D(a)| + |D(b)| + ||a| - |b|| - limit) / 2, which is |D(a)| - limit
    at least, so only the limit + 1 rarest elements of each enter the product.  Pairs that need no
    overlap are both within the limit of the pivot, which stands in for the other set then; these sets come second: (p, z, comp).
    """
    known = comps.select(F.col("id").alias("z"), "comp")
    d = deltas.join(known, "z", "left").select(
        "p", "z", F.coalesce("comp", "z").alias("comp"), "delta", F.size("delta").alias("m"),
        (F.col("n_z") - F.col("n_p")).alias("more"), limit(F.col("n_z")).alias("most"),
    )
    d = work.saved(d, "known")
    rare = F.col("m") - F.size("own")
    entries = d.drop("delta").join(_kept(d, work), ["p", "z"]).select(
        "p", "z", "comp", "m", "more", "most", rare.alias("rare"), F.posexplode("own").alias("i", "own")
    )
    entries = entries.filter("i + rare <= most").withColumn("rank", F.col("rare") + F.col("i") + 1).withColumn("e", F.col("own.e"))
    entries = work.saved(entries.drop("own", "rare"), "entries")

    def side(k: int) -> list:
        of = {"z": f"z{k}", "comp": f"c{k}", "m": f"m{k}", "more": f"n{k}", "most": f"l{k}", "rank": f"r{k}", "i": f"i{k}"}
        return ["p", "e", *[F.col(c).alias(name) for c, name in of.items()]]

    left = F.least(F.col("m1") - F.col("r1"), F.col("m2") - F.col("r2"))
    need = F.col("m1") + F.col("m2") + F.abs(F.col("n1") - F.col("n2")) - F.least("l1", "l2")
    met = entries.select(*side(1)).join(entries.select(*side(2)), ["p", "e"])
    met = met.filter(F.expr("c1 != c2 AND z1 < z2") & (2 * (F.least("i1", "i2") + 1 + left) >= need))
    met = met.groupBy("p", "z1", "z2").agg(
        F.count("*").alias("shared"), F.max("r1").alias("r1"), F.max("r2").alias("r2"),
        *[F.first(c).alias(c) for c in ("m1", "m2", "n1", "n2", "l1", "l2")],
    )
    met = met.filter(2 * (F.col("shared") + left) >= need)
    met = work.saved(met.select(F.col("z1").alias("a"), F.col("z2").alias("b")).distinct(), "candidates")
    inner = d.filter("m + abs(more) <= most").select("p", "z", "comp")
    open_ = inner.groupBy("p").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x != y").select("p")
    return met, work.saved(inner.join(open_, "p", "left_semi"), "inner")
