"""URL filters: host, path, rules and the shrunken host rates."""

import pytest
from awkward import clashing

from pedalflow.llm import urls

CASES = [
    (1, "https://A.Example.NET/en/1?x=/de/", "a.example.net", "/en/1", "example.net/en/"),
    (2, "http://x.net/en/", "x.net", "/en/", "net/"),
    (3, "http://net", "net", "", None),
    (4, "ftp://u:p@Blog.Example.com:8080/de/x#y", "u:p@blog.example.com:8080", "/de/x", None),
    (5, "http://www.example.com/de/x#y", "www.example.com", "/de/x", "example.com/de/"),
    (6, "http://a.org/fr/", "a.org", "/fr/", "org/fr/"),
    (7, "http://org/fr/?q", "org", "/fr/", "org/fr/"),
    (8, "http://xnet/", "xnet", "/", None),
    (9, None, "", "", None),
    (10, "no scheme", "", "", None),
    (11, "http://h.com?a://b.net/c", "h.com", "", None),
    (12, "://", "", "", None),
    (13, "http://a.net\n/en/x", "a.net\n", "/en/x", None),
    (14, "http://example.net/en", "example.net", "/en", "net/"),
]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "url string, good boolean")


def test_hosts_paths_and_rules(spark):
    p = pages(spark, [(i, u, None) for i, u, *_ in CASES])
    none = outcomes(spark, [])
    for df in (p, clashing(p)):
        got = {r["page_id"]: r for r in urls.judge(df, none).collect()}
        assert len(got) == len(CASES)
        for i, _, host, path, rule in CASES:
            assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
            assert got[i]["verdict"] == {None: "allow", "net/": "block", "example.com/de/": "block"}.get(rule, "allow")


@pytest.mark.parametrize(
    "host, domain, suffix",
    [
        ("a.b.example.com", "example.com", "com"),
        ("example.com", "example.com", "com"),
        ("x.example.co.uk", "example.co.uk", "co.uk"),
        ("co.uk", "co.uk", "co.uk"),
        ("localhost", "localhost", "localhost"),
        ("127.0.0.1:80", "127.0.0.1", ""),
        ("u@www.example.org:8080", "example.org", "org"),
        ("", "", ""),
    ],
)
def test_domains(spark, host, domain, suffix):
    from pyspark.sql import functions as F

    r = spark.range(1).select(urls.domain_of(F.lit(host)), urls.suffix_of(F.lit(host))).first()
    assert tuple(r) == (domain, suffix)


def test_bad_hosts_are_blocked_and_unknown_ones_inherit(spark):
    urls_ = [f"http://spam{i % 4}.bad.com/{i}" for i in range(400)] + [f"http://www.good{i % 4}.org/{i}" for i in range(400)]
    p = pages(spark, [(i, u, None) for i, u in enumerate(urls_)] + [(1000, "http://new.bad.com/", None), (1001, "http://new.org/", None)])
    o = outcomes(spark, [(u, ".org" in u or i % 20 == 0) for i, u in enumerate(urls_)] + [(urls_[0], None)])
    got = {r["page_id"]: r["verdict"] for r in urls.judge(p, o, rules=()).collect()}
    assert {got[i] for i in range(400)} == {"block"} and {got[i] for i in range(400, 800)} == {"allow"}
    assert got[1000] == "block" and got[1001] == "allow"


def test_host_rate_is_shrunk_between_its_own_and_its_domains(spark):
    rows = [("http://a.x.com/", True)] * 2 + [("http://b.x.com/", i % 4 > 0) for i in range(200)] + [("http://c.y.com/", i % 3 > 0) for i in range(200)]
    o = outcomes(spark, rows)
    p = pages(spark, [(i, u, None) for i, u in enumerate(sorted({u for u, _ in rows}))])
    r = {x["host"]: x for x in urls.reputations(p, o).collect()}
    # two good pages do not make a host perfect: it stays near its domain
    assert abs(r["a.x.com"]["mean"] - r["b.x.com"]["mean"]) < 0.05 and r["a.x.com"]["k"] / r["a.x.com"]["n"] == 1
    assert r["c.y.com"]["mean"] < r["b.x.com"]["mean"]
    assert r["a.x.com"]["upper"] - r["a.x.com"]["mean"] >= r["b.x.com"]["upper"] - r["b.x.com"]["mean"]
    assert (r["a.x.com"]["n"], r["a.x.com"]["k"]) == (2, 2)


def test_empty_tables(spark):
    assert urls.judge(pages(spark, []), outcomes(spark, [])).count() == 0
