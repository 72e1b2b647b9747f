"""Line dedup by overlapping three-line windows.

Windows of three consecutive lines are hashed; a window seen more than once in the corpus keeps
its first occurrence (smallest doc_id, then position), and the lines that later occurrences cover
are removed, overlapping windows merged.

Lines are separated by line feeds and compared without white space at their ends; blank lines are
not counted in windows. Defined results: null text stays null, a text of fewer than three lines
that are not blank stays as it is, a text whose lines are all covered becomes empty. Rows that
repeat both doc_id and text are one document read twice and get the same result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.joins import lookup

LINES = 3
SPACE = " \t\n\x0b\x0c\r"
_EDGE = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def windows(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, at (positions of the window's lines), h1, h2 (128-bit content hash)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                       F.transform(_lines(F.col("text")), lambda s: F.regexp_replace(s, _EDGE, "")).alias("lines"))
    full = F.filter(F.transform("lines", lambda s, i: F.struct(i.alias("i"), F.length(s).alias("n"), F.xxhash64(s).alias("a"), F.xxhash64(F.lit(1), s).alias("b"))),
                    lambda x: x["n"] > 0)
    rows = rows.select("doc_id", "text_hash", full.alias("lines"))
    rows = rows.filter(F.size("lines") >= LINES)
    part = lambda i: F.slice(F.col("lines"), i, LINES)
    seq = F.transform(F.sequence(F.lit(1), F.size("lines") - (LINES - 1)), lambda i: F.struct(
        F.transform(part(i), lambda x: x["i"]).alias("at"),
        F.xxhash64(F.transform(part(i), lambda x: x["a"])).alias("h1"),
        F.xxhash64(F.transform(part(i), lambda x: x["b"])).alias("h2")))
    return rows.select("doc_id", "text_hash", F.inline(seq))


def covered_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, covered: the line positions that later occurrences cover."""
    w = windows(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("doc"), "text_hash", F.col("at")[0].alias("pos"))
    repeated = w.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    later = lookup(w, repeated, ["h1", "h2"]).filter(
        ~(F.col("doc_id").eqNullSafe(F.when(~F.col("first.none"), F.col("first.doc"))) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("at")[0] == F.col("first.pos"))))
    return later.groupBy("doc_id", "text_hash").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("covered"))


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with text without the covered lines, n_lines and n_removed (columns of those names
    are replaced)."""
    base = docs.drop("n_lines", "n_removed")
    names = base.columns
    at = names.index("text")
    cover = covered_lines(base).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("covered").alias("_covered"))
    joined = base.join(cover, base["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64(base["text"]) == F.col("_hash")), "left")
    schema = T.StructType([*base.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches):
        for batch in batches:
            texts, counts, removed = batch.column(at).to_pylist(), [], []
            for i, covered in enumerate(batch.column(len(names)).to_pylist()):
                lines = [] if texts[i] is None else texts[i].split("\n")
                counts.append(len(lines))
                removed.append(len(covered or ()))
                if covered:
                    gone = set(covered)
                    kept = [s for k, s in enumerate(lines) if k not in gone]
                    texts[i] = "\n".join(kept) if any(s.strip(SPACE) for s in kept) else ""
            cols = [batch.column(i) if i != at else pa.array(texts, batch.schema.types[at]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=[*names, "n_lines", "n_removed"])

    return joined.select(*[F.col(f"`{c}`") for c in names], "_covered").mapInArrow(run, schema)
