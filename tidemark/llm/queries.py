"""The registered queries of the corpus operators, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    content_sort, ego_join, importance, langid, line_dedup, mixing, packing, pii, simhash, spelling, suffix_dedup, toxicity,
    url_filter,
)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify_languages(_documents(spark, folder))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return content_sort.content_sort_dedup(_documents(spark, folder))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(_documents(spark, folder))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_documents(spark, folder))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(_documents(spark, folder))


def _cut_lines(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    made = line_dedup.dedup_lines(docs.select("doc_id", "text"), min_words=min_words)
    cut = F.col("line_dedup")
    return made.select(
        "doc_id", cut["lines"].alias("n_lines"), cut["removed"].alias("n_removed"), cut["runs"].alias("n_runs"),
        F.sha2(F.coalesce(cut["kept"], F.lit("")), 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Parity with its SQL: runs of at least two lines."""
    return _cut_lines(_documents(spark, folder))


def op7_line_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Corrected: a long line is a run by itself."""
    return _cut_lines(_documents(spark, folder), line_dedup.PASSAGE_WORDS)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, folder))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    made = mixing.mix_copies(_documents(spark, folder))
    return made.select("doc_id", "size", "source_size", "target", "taken")


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return ego_join.embedding_groups(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, folder))


def op12_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), url_filter.RULES_DDL)
    return url_filter.judge_urls(spark.read.parquet(f"{folder}/pages.parquet"), rules)


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_exact_dedup, op3_toxicity, op4_pii, op5_suffix_dedup,
        op6_simhash, op7_line_dedup, op7_line_passages, op8_packing, op9_mixing, op10_embedding_dedup,
        op11_spelling_variants, op12_url_filters, op13_importance,
    )
}
ORACLES: dict[str, str] = {
    "op2_exact_dedup": content_sort.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op7_line_passages": line_dedup.PASSAGES_ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op10_embedding_dedup": ego_join.ORACLE,
    "op12_url_filters": url_filter.ORACLE,
}
