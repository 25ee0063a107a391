"""Structure of the driver contract."""

import os
import re

import pytest

import __spark_entry__ as E
from pedalflow.plans import oracle, registry

ROWS_ONLY = set()  # every study has SQL
SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_oracle_or_is_declared_rows_only():
    q, sql = registry.queries(), oracle.oracle_sql()
    assert set(sql) <= set(q)
    assert set(q) - set(sql) == ROWS_ONLY
    assert set(q) <= set(E.queries()) and set(sql) <= set(E.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_result_columns_are_named(spark):
    auto = re.compile(r"[()]|^count$|^sum\b|^avg\b")
    for key, fn in registry.queries().items():
        if key == "silhouette_by_k":
            continue
        cols = fn(spark, SF_DIR).columns
        assert len(cols) == len(set(cols)), key
        assert not [c for c in cols if auto.search(c)], (key, cols)


def rows_of(spark, key):
    return sorted(map(tuple, registry.queries()[key](spark, SF_DIR).collect()), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
@pytest.mark.parametrize(
    "one, other",
    [
        ("known_age_usage", "usage_by_age"),
        ("zone_balance_full", "zone_balance"),
        ("trips_by_weekday_year_outer", "trips_by_weekday_year_total"),
        ("zone_balance_null_zone", "zone_balance"),
    ],
)
def test_rules_have_rows_that_they_decide(spark, one, other):
    assert rows_of(spark, one) != rows_of(spark, other)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_an_empty_season_yields_no_row(spark):
    buckets = {(r["zone"], r["bucket"]) for r in registry.queries()["zone_stats_season"](spark, SF_DIR).collect()}
    assert ("NO WINTER", "spring") in buckets and ("NO WINTER", "winter") not in buckets


def test_nothing_but_the_guard_needs_the_corpus_operators():
    root = os.path.dirname(os.path.abspath(E.__file__))
    for folder, _, names in os.walk(os.path.join(root, "pedalflow")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name), encoding="utf-8").read()
                assert "pedalflow.llm" not in text and "from .llm" not in text and "corpus_pipeline" not in text, name
