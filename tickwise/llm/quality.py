"""Quality selection by importance resampling.

Two generative models over hashed word 1- and 2-grams are counted: one of target texts (labelled
good), one of the raw corpus. A document's log importance weight is the sum of the log-ratios of
its n-grams, tempered by the square root of their number so that length alone does not decide.
Adding Gumbel noise and keeping the k largest keys draws k documents without replacement in
proportion to their weights. The noise comes from a hash of seed, doc_id and weight, so reruns agree.

The target model is fitted on at most TARGET_ROWS labelled documents (those with the smallest
seeded hash; their ids are the only thing broadcast); the raw model counts every document.
Defined results: a text without words has weight 0; equal keys go by doc_id; rows that repeat a
doc_id and text get the same key, and all of them when the k-th key is theirs; null text has no words;
labels with a null id or a null quality mark nothing; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.text import column_bytes, gram_hashes, lower_ascii, row_chunks, word_hashes
from tickwise.session import materialize

BUCKETS = 1 << 16
SMOOTHING = 0.5
TARGET_ROWS = 20_000
KEEP_SHARE = 0.85
SEED = 29
EDGE_ROWS = 100_000     # rows around the k-th key that one task may order


def row_buckets(texts: pa.Array):
    """Buckets of the words and word pairs of every text of a column, row by row."""
    data, offsets = column_bytes(texts)
    for i, j in row_chunks(offsets):
        words, _, _, first = word_hashes(lower_ascii(data[offsets[i]:offsets[j]]), offsets[i:j + 1] - offsets[i])
        for k in range(j - i):
            w = words[first[k]:first[k + 1]]
            yield (np.concatenate([w, gram_hashes(w, 2)]) % np.uint64(BUCKETS)).astype(np.int64)


def log_ratio(docs: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """Log of target over raw probability per bucket. ``target_ids``: doc_id, TARGET_ROWS at most."""
    marked = docs.select("doc_id", "text").join(F.broadcast(target_ids.withColumn("_hit", F.lit(True))), "doc_id", "left")

    def run(batches):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for buckets, hit in zip(row_buckets(batch.column(1)), batch.column(2).to_pylist()):
                counts = np.bincount(buckets, minlength=BUCKETS) if len(buckets) > BUCKETS // 8 else None
                for total in (raw, target) if hit else (raw,):
                    if counts is None:
                        np.add.at(total, buckets, 1)
                    else:
                        total += counts
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array(raw), pa.array(target)], names=["bucket", "raw", "target"])

    rows = marked.mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    got = rows.toPandas()
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    raw[got["bucket"]] += got["raw"]
    target[got["bucket"]] += got["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, n_grams, log_weight, and key = log_weight + Gumbel noise."""

    def run(batches):
        for batch in batches:
            sums = [(len(b), float(ratio[b].sum()) / max(1.0, len(b)) ** 0.5) for b in row_buckets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in sums], pa.int64()), pa.array([s for _, s in sums], pa.float64())],
                                             names=["doc_id", "n_grams", "log_weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_grams long, log_weight double")
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "n_grams"), 11).cast("double") + 0.5) / float(1 << 53)
    return rows.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def kth_key(rows: DataFrame, k: int) -> tuple[float, int | None] | None:
    """(key, doc_id) of the k-th row by falling key, then rising doc_id; None for k = 0. The range
    that must hold it is narrowed by quantiles and exact counts until one task can order it."""
    if k <= 0:
        return None
    inside, above = rows, 0
    while True:
        total = inside.count()
        if total <= EDGE_ROWS:
            break
        want = 1 - (k - above) / total
        low, high = inside.agg(F.percentile_approx("key", [max(0.0, want - 0.005), min(1.0, want + 0.005)], 10_000).alias("q")).first()["q"]
        over = inside.filter(F.col("key") > high).count()
        part = inside.filter((F.col("key") >= low) & (F.col("key") <= high))
        n = part.count()
        if not (over < k - above <= over + n) or n == total:
            break
        inside, above = part, above + over
    order = Window.orderBy(F.col("key").desc(), F.col("doc_id").asc_nulls_last())
    row = inside.select("key", "doc_id", F.row_number().over(order).alias("r")).filter(F.col("r") == k - above).first()
    return (row["key"], row["doc_id"]) if row else None


def select_quality(docs: DataFrame, labels: DataFrame, share: float = KEEP_SHARE) -> DataFrame:
    """Per row: doc_id, n_grams, log_weight, key, kept."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    target = good.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(TARGET_ROWS)
    rows = materialize(docs.sparkSession, weigh(docs, log_ratio(docs.withColumn("doc_id", F.col("doc_id").cast("long")), target)), "quality")
    edge = kth_key(rows, round(rows.count() * share))
    if edge is None:
        return rows.withColumn("kept", F.lit(False))
    at, doc = F.lit(edge[0]), F.lit(edge[1]).cast("long")
    tie = F.coalesce(F.col("doc_id") <= doc, F.col("doc_id").isNotNull() | doc.isNull())
    return rows.withColumn("kept", (F.col("key") > at) | ((F.col("key") == at) & tie))
