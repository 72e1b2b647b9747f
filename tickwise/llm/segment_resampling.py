"""Target-distribution importance resampling with deduplicated segments.

Features are the runs of one and two words, hashed to buckets; a bucket's gain is the log-ratio of its
share of the target texts to its share of the corpus. Newlines, which separate words, cut texts into
segments (lines). A distinct line's features are computed once, whatever number of documents hold it;
corpus counts take them times the line's occurrences, and a document's sum of gains is the sum over its
lines. What lines cannot hold, the word pairs that span a line break, is added document by document.

    lines      distinct lines (grouped by their text), occurrences and buckets, written once
    documents  per row: words, digests of its lines, buckets of its cross-line pairs, written once

The driver holds one number per bucket. A line of many documents is one row of the line table; the join
of documents with line sums can split its partition. Scores are ordered by ranges with exact offsets, so
no task holds all rows.

Defined results: null and empty texts and texts without words have no features and weight 0; rows below
``LEAST_WORDS`` words are never drawn; ties go to the smaller doc_id, null ids last; repeated rows are drawn
one by one; a null doc_id is scored as the empty text. An empty table gives no rows, empty target texts
count nothing (all buckets smoothed alike).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.joins import lookup
from tickwise.llm.ordering import ranked
from tickwise.llm.text import column_bytes, lower_ascii, row_chunks
from tickwise.session import materialize

BUCKETS = 10_000
LEAST_WORDS = 20
KEEP_PERCENT = 25
SEED = 7

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & np.uint32(1), (x >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), x >> np.uint32(1))
    return x


_CRC = _crc_table()
_LONG_WORD = 48


def crc_feed(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 registers after feeding each span's bytes to its register, all spans a byte at a time;
    what a span has beyond ``_LONG_WORD`` bytes is fed at once."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    out, at, size = state[order], start[order], size[order]
    for j in range(min(int(size[0]), _LONG_WORD) if len(size) else 0):
        n = int(np.searchsorted(-size, -j, side="left"))
        out[:n] = _CRC[(out[:n] ^ data[at[:n] + j]) & np.uint32(255)] ^ (out[:n] >> np.uint32(8))
    for i in range(int(np.searchsorted(-size, -_LONG_WORD, side="left"))):
        out[i] = zlib.crc32(data[at[i] + _LONG_WORD:at[i] + size[i]].tobytes(), int(out[i] ^ _ONES)) ^ 0xFFFFFFFF
    back = np.empty_like(out)
    back[order] = out
    return back


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of lower-cased bytes; a row boundary ends a word."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:]
    last[:-1] &= ~inside[1:] | edge[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def registers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return crc_feed(np.full(len(start), _ONES, np.uint32), data, start, end)


def pair_registers(left: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Registers of word pairs (word, one space, next word), from the first words' registers and the
    spans of the next words."""
    spaced = _CRC[(left ^ np.uint32(0x20)) & np.uint32(255)] ^ (left >> np.uint32(8))
    return crc_feed(spaced, data, start, end)


def bucket_type(buckets: int):
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def line_buckets(texts: pa.Array, buckets: int = BUCKETS):
    """Per text the buckets of its words and of its word pairs."""
    data, offsets = column_bytes(texts)
    kind = bucket_type(buckets)
    for i, j in row_chunks(offsets):
        low, at = lower_ascii(data[offsets[i]:offsets[j]]), offsets[i:j + 1] - offsets[i]
        start, end, row = words_of(low, at)
        one = registers(low, start, end)
        left = np.flatnonzero(row[1:] == row[:-1])
        every = np.concatenate([one, pair_registers(one[left], low, start[left + 1], end[left + 1])]) ^ _ONES
        owner = np.concatenate([row, row[left]])
        order = np.argsort(owner, kind="stable")
        hashed = (every[order] % np.uint32(buckets)).astype(kind)
        cut = np.searchsorted(owner[order], np.arange(j - i + 1))
        for r in range(j - i):
            yield hashed[cut[r]:cut[r + 1]]


def distinct_lines(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """digest, n (occurrences), features: the distinct lines of the column ``text``."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line") != "").groupBy("line").agg(F.count("*").alias("n"))

    def run(batches):
        for batch in batches:
            digests = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in batch.column(0).to_pylist()]
            found = [b.tobytes() for b in line_buckets(batch.column(0), buckets)]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column(1), pa.array(found, pa.binary())], names=["digest", "n", "features"])

    return lines.mapInArrow(run, "digest binary, n long, features binary")


def document_rows(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """rid (unique), doc_id, words, lines (digests of the lines that hold words, in order), features
    (buckets of the pairs that span a line break)."""

    def run(batches):
        from pyspark import TaskContext
        rid, kind = TaskContext.get().partitionId() << 40, bucket_type(buckets)
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for i, j in row_chunks(offsets):
                raw, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                low = lower_ascii(raw)
                start, end, row = words_of(low, at)
                # lines: a row's start and the places after its newlines; each word's line by its place
                begin = np.unique(np.concatenate([at[:-1], np.flatnonzero(raw == 10) + 1]))
                line = np.searchsorted(begin, start, side="right") - 1
                left = np.flatnonzero((row[1:] == row[:-1]) & (line[1:] != line[:-1]))
                cross = pair_registers(registers(low, start[left], end[left]), low, start[left + 1], end[left + 1])
                hashed = ((cross ^ _ONES) % np.uint32(buckets)).astype(kind)
                held = np.unique(line)
                stop = np.append(begin[1:], len(raw))
                owner = np.searchsorted(at, begin[held], side="right") - 1
                stop = [int(s) - (s > 0 and s <= len(raw) and raw[s - 1] == 10) for s in stop[held]]
                digests = [hashlib.md5(raw[b:s].tobytes()).digest() for b, s in zip(begin[held], stop)]
                cuts, spans = np.searchsorted(owner, np.arange(j - i + 1)), np.searchsorted(row[left], np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(rid, rid + j - i)), batch.column(0).slice(i, j - i), pa.array(np.bincount(row, minlength=j - i).astype(np.int64)),
                    pa.array([digests[cuts[r]:cuts[r + 1]] for r in range(j - i)], pa.list_(pa.binary())),
                    pa.array([hashed[spans[r]:spans[r + 1]].tobytes() for r in range(j - i)], pa.binary())], names=["rid", "doc_id", "words", "lines", "features"])
                rid += j - i

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "rid long, doc_id long, words long, lines array<binary>, features binary")


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Sum of ``n`` per bucket of ``features``: one partial count per task, summed by Spark."""

    def run(batches):
        total, kind = np.zeros(buckets, np.int64), bucket_type(buckets)
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.frombuffer(raw, kind)
                if len(found) > buckets // 8:
                    total += n * np.bincount(found, minlength=buckets)
                else:
                    np.add.at(total, found, n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in rows.select("n", "features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log-ratio, floored, per bucket."""
    n = len(source)
    over, under = (target + 1.0) * float(source.sum() + n), (source + 1.0) * float(target.sum() + n)
    return np.floor(1000 * np.log(over / under)).astype(np.int64)


def gain_sums(rows: DataFrame, keys: list[str], gain: np.ndarray, schema: str) -> DataFrame:
    """``keys`` and g, the sum of gains over each row's ``features``."""

    def run(batches):
        kind = bucket_type(len(gain))
        for batch in batches:
            sums = [int(gain[np.frombuffer(raw, kind)].sum()) for raw in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], names=[*keys, "g"])

    return rows.select(*keys, "features").mapInArrow(run, f"{schema}, g long")


def resample(docs: DataFrame, target: DataFrame, percent: int = KEEP_PERCENT, least: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score, rank (null if not drawn). ``target``: a
    table whose column ``text`` shows the wanted distribution."""
    spark = docs.sparkSession
    lines = materialize(spark, distinct_lines(docs.select("text"), buckets), "segments")
    rows = materialize(spark, document_rows(docs, buckets), "segment-documents")
    goal = document_rows(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets)
    count = lambda df: bucket_counts(df, buckets)
    alone = lambda df: df.select(F.lit(1).cast("long").alias("n"), "features")
    gain = gains(count(lines) + count(alone(rows)), count(distinct_lines(target.select("text"), buckets)) + count(alone(goal)))

    own = gain_sums(rows, ["rid", "doc_id", "words"], gain, "rid long, doc_id long, words long")
    held = lookup(rows.select("rid", F.explode("lines").alias("digest")), gain_sums(lines, ["digest"], gain, "digest binary"), ["digest"])
    parts = own.unionByName(held.select("rid", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("words"), "g"))
    whole = parts.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("words").alias("words"), F.sum("g").alias("g"))
    features = F.greatest(F.lit(0), 2 * F.col("words") - 1).cast("long")
    weight = F.when(F.col("n_features") == 0, F.lit(0)).otherwise(F.expr("(g - pmod(g, greatest(n_features, 1L))) div greatest(n_features, 1L)")).cast("long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    scored = whole.withColumn("n_features", features).withColumn("weight", weight).withColumn("score", F.col("weight") + noise)
    scored = materialize(spark, scored.select("rid", "doc_id", "words", "n_features", "weight", "score"), "segment-scores")

    able = scored.filter(F.col("words") >= least)
    k = able.count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("rid")]
    places = ranked(able.select("rid", "doc_id", "score"), order, "segment-ranks").filter(F.col("place") <= k).select("rid", F.col("place").alias("rank"))
    return scored.join(places, "rid", "left").select("doc_id", "n_features", "weight", "score", "rank")
