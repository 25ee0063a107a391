"""Registered queries of the corpus operators: opN_<name>(spark, sf_dir) over whole tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, chat, decontaminate, html_text, jaccard, language, lines, oracle, packing, quality
from . import secret_scan, spelling, urls
from .common import pick, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    """The vocabulary file of op5; its folder is installed beside the libraries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"), least=lines.LEAST, bands=lines.BANDS, by_letters=lines.BY_LETTERS)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts hold control strings."""
    rows = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    more = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')"
        " AS t (conv_id, turn, role, text)"
    )
    return chat.digest(chat.render(chat.fold(chat.as_events(rows.union(more)))))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), n=3, pct=90)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document with its number: good if of quality and not toxic."""
    pages = table(spark, sf_dir, "pages")
    labels = pick(table(spark, sf_dir, "labels"), "doc_id", "quality", "toxic")
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")
    outcomes = pick(pages, "page_id", "url").join(labels, F.col("page_id") == F.col("doc_id")).select("url", good)
    return urls.judge(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(table(spark, sf_dir, "embeddings"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_language_id": op2_language_id,
        "op3_decontamination": op3_decontamination,
        "op4_html_text": op4_html_text,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_chat_format": op6_chat_format,
        "op7_quality_rules": op7_quality_rules,
        "op8_secret_scan": op8_secret_scan,
        "op9_ngram_jaccard": op9_ngram_jaccard,
        "op10_url_filter": op10_url_filter,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_bpe": op12_bpe,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
