"""Links between members of the same keys, without all pairs of a key.

Several operators know that two rows can only be close if they share a key (a line
segment, a block of n-grams).  A key may hold a third of all rows, so its members are
not paired with each other:

* Keys with two members are told from the smallest and largest id, combined map-side.
* In every key, all members are compared with one pivot, the smallest id, and linked if they
  are close.  Keys whose members are one component then are done.
* In those of at most ``few`` members the pairs of different components are compared.
* Members of larger ones get finer keys, of which close members share one at least,
  and go through the same steps again; what is left after ``turns`` turns is the operator's own
  (``last``).

Each step is exact, so the components are those of all links, whatever the groups' sizes.
Tables that a join broadcasts are counted first.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, saved

#: A table of one to three longs of at most so many rows may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Members of a key that are paired at most.
FEW = 8
#: Bits of a key: fewer make it shorter in shuffles, and keys that fall together only cost a comparison.
KEY_BITS = 48

#: Keeps the close ones of saved pairs (a, b).
Compare = Callable[[DataFrame], DataFrame]
#: Given the saved ids (column id) that can occur in pairs and the place for working tables, returns the comparison.
Prepare = Callable[[DataFrame, Scratch], Compare]
#: Given rows (key, id) and the turn, returns rows with finer keys: close ids that share a key share one of those.
Finer = Callable[[DataFrame, int], DataFrame]
#: Given saved members (key, p, id, comp) of keys that are still open and large, the components
#: (id, comp) and the comparison, returns the close pairs (a, b) of different components that share a key.
Last = Callable[[DataFrame, DataFrame, Compare, Scratch], DataFrame]


def small(numbers: DataFrame) -> bool:
    """Whether a saved table of a few number columns is proven small enough to broadcast."""
    return numbers.count() <= BROADCAST_ROWS


def only(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``keys`` (a saved table with that column, distinct)."""
    k = keys.select(on)
    return df.join(F.broadcast(k) if small(keys) else k, on, "left_semi")


def _is_star(e: DataFrame) -> bool:
    """Whether every b has one edge and no b is an a: then each a is its component's smallest id."""
    ends = e.select(F.col("a").alias("id"), F.lit(0).alias("n")).union(e.select("b", F.lit(1)))
    per = ends.groupBy("id").agg(F.sum("n").alias("ins"), F.count("*").alias("all"))
    return per.filter("ins > 1 OR (ins = 1 AND all > 1)").isEmpty()


def components(edges: DataFrame, work: Scratch) -> DataFrame:
    """(id, comp): smallest id reachable over ``edges`` (a, b), for every id in an edge.

    Alternates large-star and small-star steps (Kiveris et al. 2014) until all edges
    point from a component's smallest id; each step only takes minima per node.
    """
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    e = work.saved(ends.filter("a != b").distinct(), "edges")
    while not _is_star(e):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        star = both.join(low, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        star = star.filter("a != b").distinct()
        down = star.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(low, "u")
        small = joined.select(F.col("m").alias("a"), F.col("v").alias("b")).union(joined.select(F.col("m"), F.col("u")))
        e = work.saved(small.filter("a != b").distinct(), "edges")
    found = e.select(F.col("b").alias("id"), F.col("a").alias("comp"))
    return work.saved(found.union(e.select(F.col("a").alias("id"), F.col("a").alias("comp")).distinct()), "comps")


def with_both(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """a, b, x, y: saved pairs with the ``value`` of both ids (column id of ``values``).

    Those of b go to those of a; few pairs travel to the values instead of all values to them.
    """
    few = small(pairs)
    near = F.broadcast(pairs) if few else pairs
    ends = pairs.select("a").distinct()
    y = values.select(F.col("id").alias("b"), F.col(value).alias("y")).join(near, "b")
    x = values.select(F.col("id").alias("a"), F.col(value).alias("x")).join(F.broadcast(ends) if few else ends, "a", "left_semi")
    return y.join(x, "a").select("a", "b", "x", "y")


def open_pairs(members: DataFrame) -> DataFrame:
    """(a, b): all pairs of different components that share a key, of members (key, id, comp)."""
    one, two = (members.select("key", F.col("id").alias(i), F.col("comp").alias(c)) for i, c in (("a", "x"), ("b", "y")))
    return one.join(two, "key").filter("a < b AND x != y").select("a", "b").distinct()


def linked(
    rows: DataFrame, prepare: Prepare, last: Last, few: int = FEW, finer: Finer | None = None, turns: int = 0
) -> DataFrame | None:
    """(id, comp) of all ids that are linked: the components of all close pairs that share a key; saved.

    ``rows`` has (key, id) as longs and may repeat.  Close ids that share no key may be
    linked as well.  None if nothing is linked.  All working tables are removed again.
    """
    work = Scratch(rows.sparkSession, "link")
    close: list[DataFrame] = []
    compare: Compare | None = None
    comps = work.saved(rows.sparkSession.createDataFrame([], "id long, comp long"), "comps")

    def take(pairs: DataFrame) -> None:
        nonlocal comps
        pairs = work.saved(pairs, "close")
        if not pairs.isEmpty():
            close.append(pairs)
            comps = components(functools.reduce(DataFrame.union, close), work)

    def with_comp(df: DataFrame, name: str = "id", as_: str = "comp") -> DataFrame:
        of = comps.select(F.col("id").alias(name), F.col("comp").alias(as_))
        return df.join(of, name, "left").withColumn(as_, F.coalesce(as_, name))

    for turn in range(turns + 1):
        key = F.col("key").bitwiseAND((1 << KEY_BITS) - 1).alias("key")
        rows = rows.select(key, "id")
        shared = rows.groupBy("key").agg(F.min("id").alias("p"), F.max("id").alias("y"), F.count("*").alias("n"))
        shared = work.saved(shared.filter("p != y"), "keys")
        # most shared keys have two rows, which min and max tell; the others are looked up once more
        more = work.saved(shared.filter("n > 2").select("key", "p"), "more")
        members = only(rows, more, "key").distinct()
        members = work.saved(members.join(F.broadcast(more) if small(more) else more, "key"), "members")
        star = shared.filter("n = 2").select(F.col("p").alias("a"), F.col("y").alias("b"))
        star = star.union(members.filter("id != p").select("p", "id")).distinct()
        if turn:
            star = with_comp(with_comp(star, "a", "x"), "b", "y").filter("x != y").select("a", "b")
        star = work.saved(star, "star")
        if compare is None:
            ids = star.select(F.col("a").alias("id")).union(star.select("b")).distinct()
            compare = prepare(work.saved(ids, "ids"), work)
        take(compare(star))
        m = with_comp(members)
        open_ = m.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("c"))
        open_ = work.saved(open_.filter("x != y").select("key", "c"), "open")
        m = work.saved(m.join(F.broadcast(open_) if small(open_) else open_, "key"), "left")
        pairs = work.saved(open_pairs(m.filter(F.col("c") <= few)).join(star, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            take(compare(pairs))
        large = m.filter(F.col("c") > few)
        if large.isEmpty():
            break
        if turn == turns:
            large = work.saved(with_comp(large.select("key", "p", "id")), "large")
            take(last(large, comps, compare, work))
        else:
            rows = work.saved(finer(large.select("key", "id"), turn), "finer")
    found = None if comps.isEmpty() else saved(comps, "components")
    work.remove()
    return found
