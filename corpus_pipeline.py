"""Corpus pipeline: language ID, line dedup, n-gram Jaccard join, mixing sources, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's input. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import langid, line_dedup, mixing, ngram_join, packing
from tickwise.session import apply_runtime_conf, materialize
from tickwise.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents without a recognisable language go (``langid.classify``: ``known``),
    however many languages they mix; ``lang`` becomes the prediction."""
    apply_runtime_conf(spark)
    kept = langid.classify(docs).filter("known")
    return kept.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: later occurrences of repeated three-line windows go; a document of which nothing
    is left goes with them."""
    apply_runtime_conf(spark)
    out = line_dedup.remove_lines(docs).filter((F.col("n_removed") == 0) | (F.col("text") != ""))
    return out.select("doc_id", "text", "lang", "source", F.when(F.col("text").isNotNull(), F.length("text")).cast("long").alias("n_chars"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1 on sets of 5-word shingles, J >= 8/10: one document of each group of near copies stays."""
    apply_runtime_conf(spark)
    return ngram_join.keep_one(docs, words=5, num=8, den=10).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: each document as often as the mix takes it."""
    apply_runtime_conf(spark)
    out, _ = mixing.mix(docs.select(*COLUMNS), F.array(F.col("source").cast("string")), mixing.word_count(F.col("text")))
    return out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("repeats").cast("int")))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the pieces of all documents."""
    apply_runtime_conf(spark)
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("ngram_jaccard", ngram_jaccard),
          ("source_mixing", source_mixing), ("packing", packing_stage)]

# Language prediction cannot be written in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table; each result but the last is a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
