"""Catalog of the training-data queries; each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import (exact_dedup, fingerprints, langid, line_dedup, mixing, ngram_join, packing, quality, rotated_codes,
                          secret_scan, segment_resampling, suffix_dedup, token_alignment)
from tickwise.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


@register("op1_ngram_jaccard")
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash")


@register("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@register("op3_source_mixing")
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_by_source(table(spark, sf_dir, "documents"))


@register("op4_quality_resampling")
def op4_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.select_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op5_exact_dedup", """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS sha FROM documents),
     r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY sha ORDER BY n DESC, doc_id) AS keep_id,
                  count(*) OVER (PARTITION BY sha) AS group_size FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM r
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@register("op6_line_dedup", """
WITH l AS (SELECT doc_id, i, regexp_replace(regexp_replace(s, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', '') AS s
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)),
     f AS (SELECT doc_id, i, s, lead(i, 1) OVER w AS i1, lead(i, 2) OVER w AS i2, lead(s, 1) OVER w AS s1, lead(s, 2) OVER w AS s2
           FROM l WHERE s <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
     o AS (SELECT *, row_number() OVER (PARTITION BY s, s1, s2 ORDER BY doc_id, i) AS nth FROM f WHERE i2 IS NOT NULL),
     c AS (SELECT doc_id, i FROM o WHERE nth > 1 UNION SELECT doc_id, i1 FROM o WHERE nth > 1 UNION SELECT doc_id, i2 FROM o WHERE nth > 1),
     k AS (SELECT r.doc_id, string_agg(r.s, chr(10) ORDER BY r.i) FILTER (c.i IS NULL) AS kept, bool_and(trim(r.s, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) = '') FILTER (c.i IS NULL) AS blank,
                  count(*) AS n_lines, count(c.i) AS n_removed
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents) r
           LEFT JOIN c ON c.doc_id = r.doc_id AND c.i = r.i GROUP BY r.doc_id)
SELECT d.doc_id, CASE WHEN coalesce(k.n_removed, 0) = 0 THEN d.text WHEN coalesce(k.blank, true) THEN '' ELSE k.kept END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
""")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return out.select("doc_id", F.size("repeats").cast("long").alias("n_repeats"), text("repeats").alias("repeats"), text("removed").alias("removed"), "repeated_words")


@register("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.predict_all(table(spark, sf_dir, "documents"))
    return out.withColumn("languages", F.array_join("languages", ","))


@register("op9_scaled_fingerprints")
def op9_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


@register("op10_mixture_packing")
def op10_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op11_rotated_codes")
def op11_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotated_codes.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@register("op12_segment_resampling")
def op12_segment_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"))
