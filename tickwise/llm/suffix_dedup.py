"""Repeated passages by sparse suffixes, grouped by their first MIN_WORDS words.

Only suffixes at content-selected places are kept: of every WINDOW consecutive GRAM-word grams the
one with the smallest hash (minimiser), so any common passage of MIN_WORDS words has a kept place
at the same word in both documents. Places whose gram occurs in one document only are dropped.

Every MIN_WORDS-word window belongs to one place, its minimiser. The windows of the places left are
grouped by their words with partial aggregates (the suffixes that a sort would bring together on so
many words), so every window held by two or more documents is found, whatever else shares its gram,
and a passage shared by very many documents is spread over tasks. A document's windows are merged
into spans. Windows are named by 64-bit hashes of their words; words are maximal runs without white
space.

Defined results: null and short texts have no spans; matches within one document do not count;
rows that repeat doc_id and text are one document. Spans are code points, ends exclusive. A span
is ``removed`` where a window's first document (smallest doc_id) is another one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.joins import lookup
from tickwise.llm.text import column_bytes, gram_hashes, row_chunks, word_hashes
from tickwise.session import materialize

MIN_WORDS = 50
GRAM = 20
WINDOW = MIN_WORDS - GRAM + 1
BATCH = 1 << 16               # windows in a batch, those of one text at least


def window_minimisers(grams: np.ndarray) -> np.ndarray:
    """Position of the smallest (leftmost) gram hash of every WINDOW consecutive grams."""
    if len(grams) < WINDOW:
        return np.zeros(0, np.int64)
    picked = []
    for a in range(0, len(grams) - WINDOW + 1, 1 << 16):
        part = grams[a:a + (1 << 16) + WINDOW - 1]
        picked.append(np.lib.stride_tricks.sliding_window_view(part, WINDOW).argmin(axis=1) + np.arange(a, a + len(part) - WINDOW + 1))
    return np.concatenate(picked)


def minimisers(grams: np.ndarray) -> np.ndarray:
    return np.unique(window_minimisers(grams))


def _rows(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.withColumn("rid", F.xxhash64("doc_id", "text_hash"))


def _anchors(docs: DataFrame) -> DataFrame:
    """rid, doc_id, grams and their word positions."""

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            g_all, p_all, sizes = [], [], []
            for i, j in row_chunks(offsets):
                words, _, _, first = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for k in range(j - i):
                    grams = gram_hashes(words[first[k]:first[k + 1]], GRAM)
                    at = minimisers(grams)
                    g_all.append(grams[at].view(np.int64)), p_all.append(at.astype(np.int32)), sizes.append(len(at))
            edge = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edge, pa.array(np.concatenate(x) if x else np.zeros(0, t))) for x, t in ((g_all, np.int64), (p_all, np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["rid", "doc_id", "grams", "at"])

    return _rows(docs).select("rid", "doc_id", "text").mapInArrow(run, "rid long, doc_id long, grams array<long>, at array<int>")


def _windows(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """rid, doc_id, pos and name of the MIN_WORDS-word windows whose minimiser is one of ``ats``."""

    def run(batches):
        out: list[tuple] = []

        def emit():
            counts = [len(p) for _, _, p, _ in out]
            cols = [np.repeat(np.array([o[c] for o in out], object), counts).tolist() for c in (0, 1)]
            cols += [np.concatenate([o[2] for o in out]), np.concatenate([o[3] for o in out])]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["rid", "doc_id", "pos", "name"])

        held = 0
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            ids, docs_, places = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for i, j in row_chunks(offsets):
                words, _, _, first = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for k in range(j - i):
                    own = words[first[k]:first[k + 1]]
                    at = np.flatnonzero(np.isin(window_minimisers(gram_hashes(own, GRAM)), places[i + k]))
                    name = gram_hashes(own, MIN_WORDS).view(np.int64)
                    for x in range(0, len(at), BATCH):
                        part = at[x:x + BATCH]
                        out.append((ids[i + k], docs_[i + k], part.astype(np.int32), name[part]))
                        held += len(part)
                        if held >= BATCH:
                            yield emit()
                            held = 0
        if out:
            yield emit()

    source = _rows(docs).withColumnRenamed("rid", "_rid").select("_rid", "text")
    joined = source.join(hits, F.col("_rid") == F.col("rid")).dropDuplicates(["rid"])
    return joined.select("rid", "doc_id", "text", "ats").mapInArrow(run, "rid long, doc_id long, pos int, name long")


def _merge(starts: list[int]) -> list[tuple[int, int]]:
    """Spans of words that the windows at ``starts`` cover; windows that touch are one span."""
    at = np.unique(np.array(starts, np.int64))
    cut = np.flatnonzero(np.diff(at) > MIN_WORDS)
    return [(int(a), int(b) + MIN_WORDS) for a, b in zip(at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]])] if len(at) else []


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, repeats and removed (arrays of (start, end)), repeated_words."""
    spark = docs.sparkSession
    anchors = materialize(spark, _anchors(docs), "suffix-anchors")
    places = anchors.select("rid", "doc_id", F.explode(F.arrays_zip("grams", "at")).alias("x")).select("rid", "doc_id", F.col("x.grams").alias("gram"), F.col("x.at").alias("at"))
    shared = places.groupBy("gram").agg(F.min("rid").alias("lo"), F.max("rid").alias("hi")).filter("lo < hi").select("gram")
    shared = materialize(spark, shared, "suffix-shared")
    hits = materialize(spark, places.join(shared, "gram").groupBy("rid", "doc_id").agg(F.collect_list("at").alias("ats")), "suffix-hits")
    windows = materialize(spark, _windows(docs, hits.filter(F.size("ats") > 0)), "suffix-windows")
    first = windows.groupBy("name").agg(F.min(F.struct("doc_id", "rid")).alias("f"), F.min("rid").alias("lo"), F.max("rid").alias("hi"))
    first = materialize(spark, first.filter("lo < hi").select("name", F.col("f.rid").alias("_first")), "suffix-first")
    spans = lookup(windows, first, ["name"]).select(F.col("rid").alias("_rid"), "pos", (F.col("rid") != F.col("_first")).alias("later"))
    spans = spans.groupBy("_rid").agg(F.collect_list("pos").alias("at"), F.collect_list(F.when(F.col("later"), F.col("pos"))).alias("later"))
    spans = materialize(spark, spans, "suffix-spans")

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            starts, later = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            repeats, removed, count = [], [], []
            for k in range(batch.num_rows):
                raw = data[offsets[k]:offsets[k + 1]]
                _, start, end, _ = word_hashes(raw, np.array([0, len(raw)]))
                # byte to code point offsets: count bytes that do not continue a character
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                points = lambda s: [{"start": int(chars[start[a]]), "end": int(chars[end[b - 1]])} for a, b in s]
                whole = _merge(starts[k])
                repeats.append(points(whole))
                removed.append(points(_merge(later[k])))
                count.append(sum(b - a for a, b in whole))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(repeats, kind), pa.array(removed, kind), pa.array(count, pa.int64())], names=["_r", "repeats", "removed", "repeated_words"])

    texts = _rows(docs).join(spans.filter(F.size("at") > 0), F.col("rid") == F.col("_rid")).select("rid", "text", "at", "later").dropDuplicates(["rid"])
    hit = texts.mapInArrow(run, "_r long, repeats array<struct<start:long,end:long>>, removed array<struct<start:long,end:long>>, repeated_words long")
    out = anchors.select("rid", "doc_id").join(hit, F.col("rid") == F.col("_r"), "left")
    return out.select("doc_id", F.coalesce("repeats", F.array()).alias("repeats"), F.coalesce("removed", F.array()).alias("removed"), F.coalesce("repeated_words", F.lit(0)).alias("repeated_words"))
