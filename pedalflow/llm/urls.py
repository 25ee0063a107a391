"""URL filters: fixed host/path rules, then empirical-Bayes host reputation (DataFrame functions only).

Labelled page outcomes (good or not) are counted per host, registered domain
and suffix.  Each level's spread gives a beta prior by moments; a suffix is
shrunk towards the overall rate, a domain towards its suffix, a host towards
its domain.  A host is blocked when the upper bound of its posterior good rate
lies under ``min_good``; hosts without labels inherit their domain's posterior.
Only counts are shuffled, pre-aggregated per task, so a hot host is one row a
task; the verdict table has one row a host and joins the pages under AQE, which
splits a hot host's rows or broadcasts the table when it is small.

Defined cases: a null url or one without ``://`` has an empty host and path and
no rule; the empty host has a reputation like any other.  A null outcome is
not counted; repeated outcomes count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, pick, saved

#: Second-level labels that act as suffixes under two-letter country codes.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    """A host with a path prefix (``example.net/en/``) and what it does."""

    text: str
    action: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The public part of a host name: its last label, or two under a country code."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    two = rf"(?:^|\.)((?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}})$"
    ip = bare.rlike(r"^[0-9.]+$|^\[")
    return F.when(ip, F.lit("")).when(bare.rlike(two), F.regexp_extract(bare, two, 1)).otherwise(
        F.substring_index(bare, ".", -1)
    )


def domain_of(host: Column) -> Column:
    """The registered domain: one label more than the suffix; an address or a bare suffix is its own."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    s = suffix_of(host)
    front = F.substring(bare, F.lit(1), F.greatest(F.length(bare) - F.length(s) - 1, F.lit(0)))
    return F.when((s == "") | (front == ""), bare).otherwise(F.concat_ws(".", F.substring_index(front, ".", -1), s))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest fitting rule as struct(text, action), or null.  ``rules`` is a short list of the caller's."""
    found = F.lit(None).cast("struct<text:string,action:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.action).alias("action"))).otherwise(found)
    return found


def _strengths(nodes: DataFrame) -> DataFrame:
    """(level, strength): what a beta prior of the level weighs, in labelled pages, by the method of moments."""
    seen = nodes.filter("n > 0")
    sums = seen.groupBy("level").agg(F.sum("n").alias("total"), (F.sum("k") / F.sum("n")).alias("mu"))
    w = F.col("n") / F.col("total")
    parts = seen.join(F.broadcast(sums), "level").groupBy("level").agg(  # three rows
        F.max("mu").alias("mu"),
        F.sum(w * F.pow(F.col("k") / F.col("n") - F.col("mu"), 2)).alias("s"),
        F.sum(w * (1 - w)).alias("u"),
        F.sum(w * (1 - w) / F.col("n")).alias("v"),
    )
    pq = F.col("mu") * (1 - F.col("mu"))
    spread = F.try_divide(F.col("s") - pq * F.col("v"), pq * (F.col("u") - F.col("v")))
    strength = F.when(spread.isNull() | (spread <= 0.001), 1000.0).when(spread >= 0.5, 1.0).otherwise(1 / spread - 1)
    return parts.select("level", F.round(strength, 6).alias("strength"))


def reputations(pages: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """One row per host of ``pages``: posterior ``mean`` and ``upper`` bound of its good rate.

    ``outcomes`` has a url and a boolean ``good`` per labelled page.
    """
    host_counts = (
        pick(pages, "url").select(host_of(F.col("url")).alias("host"), F.lit(0).alias("n"), F.lit(0).alias("k"))
        .unionByName(
            pick(outcomes, "url", "good").filter("good IS NOT NULL").select(
                host_of(F.col("url")).alias("host"), F.lit(1).alias("n"), F.col("good").cast("int").alias("k")
            )
        )
        .groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    )
    hosts = saved(
        host_counts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))), "hosts"
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    strengths = _strengths(
        hosts.select(F.lit("host").alias("level"), "n", "k")
        .unionByName(domains.select(F.lit("domain").alias("level"), "n", "k"))
        .unionByName(suffixes.select(F.lit("suffix").alias("level"), "n", "k"))
    )

    def shrunk(nodes: DataFrame, level: str) -> DataFrame:
        """Posterior mean and weight of ``nodes`` given the prior mean in ``prior``."""
        own = strengths.filter(F.col("level") == level).select("strength").scalar()
        s = F.coalesce(own, F.lit(1.0))
        n = nodes.withColumn("s", s)
        mean = (F.col("prior") * F.col("s") + F.col("k")) / (F.col("s") + F.col("n"))
        return n.withColumn("mean", mean).withColumn("weight", F.col("s") + F.col("n")).drop("s", "prior")

    overall = suffixes.select(((F.sum("k") + 1) / (F.sum("n") + 2))).scalar()
    top = shrunk(suffixes.withColumn("prior", overall), "suffix").select("suffix", F.col("mean").alias("prior"))
    mid = shrunk(domains.join(top, "suffix"), "domain").select("domain", "suffix", F.col("mean").alias("prior"))
    low = shrunk(hosts.join(mid, ["domain", "suffix"]), "host")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return low.select("host", "domain", "suffix", "n", "k", "mean", (F.col("mean") + z * sd).alias("upper"))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, min_good: float = 0.5, z: float = 1.645
) -> DataFrame:
    """page_id, host, path, rule, verdict, mean and upper of every page."""
    urls = pick(pages, "page_id", "url")
    p = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    p = p.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    table = saved(reputations(pages, outcomes, z), "reputations").select("host", "mean", "upper")
    own = F.when(F.col("upper") < min_good, "block").otherwise("allow")
    return p.join(table, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("fit.text").alias("rule"),
        F.coalesce(F.col("fit.action"), own).alias("verdict"),
        F.round("mean", 6).alias("mean"),
        F.round("upper", 6).alias("upper"),
    )
