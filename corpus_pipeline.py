"""A training corpus from raw documents: language, repeated lines, near-duplicates, mixture, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, line_dedup, mixing, packing, simhash
from tidemark.llm.common import WORD, prepare, with_row_key
from tidemark.session import shared_folder


# A document goes when the network is hardly surer of its best language than of an even draw among all
# it knows: this is the least share of the way from an even draw (0) to certainty (1). With four
# languages it is a score of 0.2875; the lowest score of a labelled document at sf0.1 is 0.305.
LEAST_CERTAIN = 0.05


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without text or any letter go, and those the network cannot tell.

    Where fewer than two languages can be learned there is nothing to tell apart, and every document with
    a letter stays. Null identifiers and repeated rows are rows of their own; texts are read whole; a
    tie of two languages is judged like any other score; an empty table gives an empty result.
    """
    rows, _ = with_row_key(docs, key="__row")
    network, languages = langid.fit(docs)
    if len(languages) < 2:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    even = 1.0 / len(languages)
    named = rows.select(F.col("__row").alias("doc_id"), "text", "lang")
    found = langid.identify_languages(named, model=(network, languages))
    known = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= even + (1 - even) * LEAST_CERTAIN))
    known = known.select(F.col("doc_id").alias("__known"))
    return rows.join(known, F.col("__row") == F.col("__known"), "left_semi").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs and of long lines are cut out; a document that loses all its words goes."""
    made = line_dedup.dedup_lines(docs, out="__cut", min_words=line_dedup.PASSAGE_WORDS)
    removed, kept = F.col("__cut")["removed"], F.col("__cut")["kept"]
    made = made.where((removed == 0) | kept.rlike(WORD))
    made = made.withColumn("text", kept)
    if "n_chars" in docs.columns:
        length = F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars"))
        made = made.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return made.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates, the document with the smallest identifier."""
    rows, _ = with_row_key(docs, key="__row")
    groups = simhash.simhash_groups(rows, id_col="__row")
    first = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__first"))
    return rows.join(first, F.col("__row") == F.col("__first"), "left_semi").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix_sources(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece of a document."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# Language and near-duplicates have no SQL form; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again; the last stage's rows."""
    prepare(spark)
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
