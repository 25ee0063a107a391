"""The pipeline against a plain run of its stages, and the queries' registration."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from awkward import ODD_ROWS, clashing, docs  # noqa: E402
from test_jaccard import brute as linked  # noqa: E402
from test_decontaminate import brute as contaminated  # noqa: E402
from test_lines import brute as repeated  # noqa: E402

from pedalflow.llm import lines, quality, registry  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    import __spark_entry__ as E

    ops = {k.split("_")[0] for k in E.queries() if k.startswith("op")}
    assert ops == {f"op{n}" for n in range(1, 14)} and "pipeline" in E.queries()
    assert set(E.oracle_sql()) <= set(E.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard", "decontamination", "best_fit_packing"]
    assert set(registry.queries()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_stages_against_brute_force(spark):
    d = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r["clean_text"] for r in quality.judge(d).collect() if r["kept"]}
    step = lambda name, docs_: dict(corpus_pipeline.STAGES)[name](spark, docs_, SF_DIR)

    one = step("quality_rules", d)
    assert one.columns == DOCUMENTS and {r["doc_id"]: r["text"] for r in one.collect()} == rows

    gone = repeated(list(rows.items()), lines.TAU, lines.MIN_CHARS, lines.LEAST, lines.BANDS, lines.BY_LETTERS)
    rows = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())) for i, t in rows.items()}
    rows = {i: t for i, t in rows.items() if i not in gone or t.strip()}
    two = step("line_dedup", one)
    assert two.columns == DOCUMENTS and {r["doc_id"]: r["text"] for r in two.collect()} == rows

    firsts = {i for i, _, c in linked(list(rows.items()), 5, 80) if i == c}
    three = step("ngram_jaccard", two)
    rows = {i: t for i, t in rows.items() if i in firsts}
    assert three.columns == DOCUMENTS and {r["doc_id"]: r["text"] for r in three.collect()} == rows

    bad = {r[0] for r in contaminated(list(rows.items()), bench) if r[-1]}
    four = step("decontamination", three)
    rows = {i: t for i, t in rows.items() if i not in bad}
    assert four.columns == DOCUMENTS and {r["doc_id"]: r["text"] for r in four.collect()} == rows

    packed = step("best_fit_packing", four).collect()
    assert {r["doc_id"] for r in packed} == set(rows)
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def test_stages_take_awkward_documents(spark):
    d = clashing(docs(spark, ODD_ROWS))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (d, d.limit(0)):
            assert stage(spark, df, SF_DIR).columns == DOCUMENTS, name
    assert corpus_pipeline.STAGES[-1][1](spark, d.limit(0), SF_DIR).count() == 0
