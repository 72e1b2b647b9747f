"""Threshold-scaled sketches of documents (FracMinHash).

A document's sketch is every 5-word shingle hash below a fixed fraction 1/SCALE of the hash
range. The rule looks at one hash at a time, so the sketch of a union is the union of the
sketches (mergeable across partitions or days), and |A n B| / |A| is estimated on sketches of
very unequal sizes without bias.

Defined results: null text counts as empty; a text of one to four words has its whole sequence
as one shingle; a text without words has none. A sketch can be empty (few shingles, none below
the threshold): its likeness is 1 to an equal shingle set and 0 to any other. The fingerprint
holds the number of shingles and a digest of the whole shingle set before the retained hashes,
so texts of equal shingles have equal fingerprints and others do not.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.text import CHUNK_BYTES, row_shingles, strings_bytes, text_runs, word_hashes

SHINGLE_WORDS = 5
SCALE = 4


def sketch(shingles: np.ndarray, scale: int = SCALE) -> tuple[str, np.ndarray]:
    """Fingerprint text and sorted retained hashes of one document's shingle hashes."""
    distinct = np.unique(shingles)
    kept = distinct[distinct < np.uint64((1 << 64) // scale)]
    whole = hashlib.blake2b(distinct.astype("<u8").tobytes(), digest_size=8).hexdigest()
    body = base64.b64encode(kept.astype("<u8").tobytes()).decode()
    return f"{len(distinct)}:{whole}:{body}", kept


def sketches(texts: list[str], k: int = SHINGLE_WORDS, scale: int = SCALE) -> list[tuple[str, np.ndarray]]:
    data, offsets = strings_bytes(texts)
    words, _, _, first = word_hashes(data, offsets)
    return [sketch(s, scale) for s in row_shingles(words, first, k)]


def likeness(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    """Estimated containment of the smaller shingle set in the larger, 0 to 1."""
    if a[0] == b[0]:
        return 1.0
    least = min(len(a[1]), len(b[1]))
    if least == 0:
        return 0.0
    return len(np.intersect1d(a[1], b[1], assume_unique=True)) / least


def jaccard(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    if a[0] == b[0]:
        return 1.0
    both = len(np.intersect1d(a[1], b[1], assume_unique=True))
    return both / max(1, len(a[1]) + len(b[1]) - both)


def fingerprint(docs: DataFrame, text: str = "text", scale: int = SCALE) -> DataFrame:
    """``docs`` with a ``fingerprint`` column (replaced if present)."""
    keep = docs.drop("fingerprint")
    schema = T.StructType([*keep.schema.fields, T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.names.index(text)).to_pylist()]
            prints: list[str] = []
            for part in text_runs(texts):
                prints += [p for p, _ in sketches(part, scale=scale)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())],
                                             names=[*batch.schema.names, "fingerprint"])

    return keep.mapInArrow(run, schema)


def with_next(docs: DataFrame, order: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """Rows dealt into ranges of ``order`` and sorted there, columns (bucket, extra, doc_id, text).

    Each range ends with a copy (``extra`` = 1) of the first row of the next range, the last
    with that of the first, so each task sees every row of its range together with the row that
    follows it. One exchange; the driver holds the range bounds and each range's smallest id.
    Null ids come first. Rows of equal ids follow each other in order of their texts.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    ids = docs.select(F.coalesce(F.col(order).cast("long"), F.lit(least)).alias("id"))
    ranges = 8 * n    # several to a task, so that tasks come out even
    cuts = [i / ranges for i in range(1, ranges)]
    bounds = ids.agg(F.percentile_approx("id", cuts, 10_000).alias("b")).first()["b"]
    edges = np.unique(np.array(bounds or [], dtype=np.int64))

    @F.pandas_udf("int")
    def bucket_of(v):
        import pandas as pd
        return pd.Series(np.searchsorted(edges, v.to_numpy(np.int64), side="left").astype(np.int32))

    firsts = {r["b"]: r["m"] for r in ids.groupBy(bucket_of("id").alias("b")).agg(F.min("id").alias("m")).collect()}
    filled = sorted(firsts)
    before = {firsts[b]: filled[i - 1] for i, b in enumerate(filled)}

    @F.pandas_udf("array<int>")
    def places(v):
        import pandas as pd
        at = np.searchsorted(edges, v.to_numpy(np.int64), side="left")
        return pd.Series([[int(b), before[i]] if i in before else [int(b)] for i, b in zip(v.tolist(), at)])

    rows = docs.select(F.col(order).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("at", places(F.coalesce("doc_id", F.lit(least))))
    rows = rows.select("doc_id", "text", F.posexplode("at").alias("extra", "bucket"))
    return (rows.repartition(n, "bucket").select("bucket", "extra", "doc_id", "text")
            .sortWithinPartitions("bucket", "extra", F.col("doc_id").asc_nulls_first(), "text"))


NEXT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double, jaccard_edited double, jaccard_next double")


def compare_with_next(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprints of each text, of its edited form (last quarter replaced by the head of the
    next document) and their likeness; see ``with_next`` for the order. A single row is its own
    next document."""

    def pairs(batches):
        held = None
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(4)]
            for bucket, extra, doc, text in zip(*cols):
                if held is not None and held[0] == bucket and not held[1]:
                    yield held[2], held[3], text
                held = (bucket, extra, doc, text)

    def block(rows):
        edited = []
        for _, text, after in rows:
            q = len(text) // 4
            edited.append(text[:len(text) - q] + after[:q])
        own = sketches([r[1] for r in rows], scale=scale)
        new = sketches(edited, scale=scale)
        # the next row's sketch is the following entry, but for the last row or a change of range
        nxt = [own[i + 1] if i + 1 < len(rows) and rows[i + 1][1] == rows[i][2] else sketches([rows[i][2]], scale=scale)[0]
               for i in range(len(rows))]
        sha = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array(sha, pa.string()), pa.array([o[0] for o in own], pa.string()), pa.array([e[0] for e in new], pa.string()),
            pa.array([likeness(o, e) for o, e in zip(own, new)], pa.float64()),
            pa.array([likeness(o, e) for o, e in zip(own, nxt)], pa.float64()),
            pa.array([jaccard(o, e) for o, e in zip(own, new)], pa.float64()),
            pa.array([jaccard(o, e) for o, e in zip(own, nxt)], pa.float64()),
        ], names=[f.split()[0] for f in NEXT_SCHEMA.split(", ")])

    def run(batches):
        rows, size = [], 0
        for row in pairs(batches):
            rows.append(row)
            size += len(row[1])
            if size >= CHUNK_BYTES // 2:
                yield block(rows)
                rows, size = [], 0
        if rows:
            yield block(rows)

    return with_next(docs).mapInArrow(run, NEXT_SCHEMA)
