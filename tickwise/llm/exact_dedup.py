"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

1. Each text, white space removed, is cut at places chosen by its content, so equal passages in
   different documents give equal chunks.
2. Chunks are deduplicated by content: grouped by (digest, chunk), a digest that stands for one
   content only becomes a verified identifier; one that stands for two stops the job.
3. A document is from then on its recipe, the ordered list of verified identifiers. Recipes,
   not texts, are compared, so a long document is moved once (as chunks) and never again.

Defined results: null text counts as empty; empty texts are equal to each other; rows repeating a
doc_id count as rows of their own, rows that also repeat the text get the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.joins import lookup

# A chunk ends after a letter pair of these classes (about one place in 300 of prose), not before
# MIN_CHUNK code points and at the latest after MAX_CHUNK.
MIN_CHUNK = 512
MAX_CHUNK = 4096
_CUT = "[hlmtuzg47HLMTUZ][bdkpvwy19BDKPVWY]"
CHUNK_PATTERN = f"(?s).{{{MIN_CHUNK - 2},{MAX_CHUNK - 2}}}?{_CUT}|.{{1,{MAX_CHUNK}}}"
_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, "")


def chunks(norm: Column) -> Column:
    """Content-defined chunks; joined they are ``norm`` again."""
    return F.when(norm == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(norm, F.lit(CHUNK_PATTERN), F.lit(0)))


def chunked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per chunk and document: row key (doc_id, n_chars, sha), pos, chunk, digest. The
    empty text has the empty chunk."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long").alias("n_chars"),
                       normalised(F.col(f"`{text}`")).alias("norm"))
    rows = rows.select("doc_id", "n_chars", F.unhex(F.sha2("norm", 256)).alias("sha"), F.posexplode(chunks(F.col("norm"))).alias("pos", "chunk"))
    return rows.withColumn("digest", F.unhex(F.sha2("chunk", 256)))


def verified_chunks(pieces: DataFrame) -> DataFrame:
    """The chunk store's identifiers: one row per digest, raising when two contents share one."""
    store = pieces.groupBy("digest", "chunk").agg(F.count("*").alias("uses"))
    once = store.groupBy("digest").agg(F.count("*").alias("contents"))
    checked = F.when(F.col("contents") == 1, F.col("digest")).otherwise(F.raise_error(F.lit("two chunk contents share a digest")).cast("binary"))
    return once.select("digest", checked.alias("chunk_id"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the row with the
    most code points in the original text stays, then the smallest doc_id (a null id last)."""
    pieces = chunked(docs, doc_id, text)
    ids = verified_chunks(pieces)
    # a digest is looked up by its occurrences; the join splits the partitions of frequent chunks
    named = lookup(pieces.select("doc_id", "n_chars", "sha", "pos", "digest"), ids, ["digest"])
    rows = named.groupBy("doc_id", "n_chars", "sha").agg(
        F.sort_array(F.collect_set(F.struct("pos", "chunk_id"))).alias("parts"),
        F.sum((F.col("pos") == 0).cast("long")).alias("copies"))
    rows = rows.select("doc_id", "n_chars", "sha", "copies", F.transform("parts", lambda p: p["chunk_id"]).alias("recipe"))
    best = F.struct(F.col("n_chars").alias("a"), F.coalesce(-F.col("doc_id"), F.lit(-(1 << 63))).alias("b"))
    groups = rows.groupBy("recipe").agg(F.max(best).alias("best"), F.sum("copies").alias("group_size"))
    groups = groups.select("recipe", F.when(F.col("best.b") > -(1 << 63), -F.col("best.b")).alias("keep_id"), F.col("best.a").alias("keep_chars"), "group_size")
    out = lookup(rows, groups, ["recipe"])
    out = out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                     (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
                     F.lower(F.hex("sha")).alias("text_sha256"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
    return out.drop("_copy")
