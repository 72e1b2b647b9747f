"""Language identification by multilingual mixture inference.

Training counts hashed byte n-grams per label over all labelled rows; a language model is the
smoothed n-gram distribution. A document is a mixture of languages: expectation-maximisation
estimates the proportions from the n-gram likelihoods, and languages join the set one by one as
long as the log-likelihood gains more than a BIC penalty.

A document is ``known`` unless it is ``und`` or the background, all n-grams alike, explains it better
than the chosen languages by more than that penalty; a text shorter than one n-gram has no evidence
against it.

Defined results: null texts and texts without a letter are ``und`` with score 0; ties go to the
language whose name sorts first; without any training rows every text is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.text import column_bytes, mix64, row_chunks

GRAM = 4            # bytes per n-gram
BUCKETS = 1 << 15   # hashed n-grams
SMOOTHING = 0.5     # added to each count
EM_STEPS = 12
UNKNOWN = "und"

# ASCII letters fold to lower case, everything else in ASCII to one gap; other bytes stay.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def has_letter(text: str) -> bool:
    """A letter in the sense of ``str.isalpha``: superscripts, fractions and number forms are none."""
    return any(c.isalpha() for c in text)


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and bucket of every n-gram that lies within one row and is not all gap."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    folded = _FOLD[data].astype(np.uint64)
    code = np.zeros(n, np.uint64)
    for i in range(GRAM):
        code = (code << np.uint64(8)) | folded[i:i + n]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = row[:n] == row[GRAM - 1:]
    keep &= code != np.uint64(int.from_bytes(b" " * GRAM))
    return row[:n][keep], (mix64(code[keep]) % np.uint64(BUCKETS)).astype(np.int64)


def train(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Labels and their log-probabilities, [labels, BUCKETS], from (text, lang). All rows count;
    the driver receives at most BUCKETS numbers per label."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            data, offsets = column_bytes(batch.column(0))
            for i, j in row_chunks(offsets):
                row, bucket = gram_buckets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                names = sorted(set(langs[i:j]))
                code = np.array([names.index(x) for x in langs[i:j]], np.int64)
                counts = np.bincount(code[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for name, c in zip(names, counts):
                    total[name] = total.get(name, 0) + c
        for name, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.int64))],
                                             names=["lang", "bucket", "n"])

    counted = rows.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.toPandas()
    labels = sorted(got["lang"].unique())
    counts = np.zeros((len(labels), BUCKETS))
    counts[np.searchsorted(labels, got["lang"]) if len(got) else [], got["bucket"].to_numpy(int)] = got["n"]
    counts += SMOOTHING
    return labels, np.log(counts / counts.sum(axis=1, keepdims=True))


def mixture(weights: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Languages chosen (columns of ``logp``) and their proportions for one document with n-gram
    counts ``weights`` and log-probabilities ``logp`` [n-grams, languages]."""
    total = weights.sum()
    single = weights @ logp
    chosen = [int(np.argmax(single))]
    share, best = np.ones(1), float(single[chosen[0]])
    shifted = np.exp(logp - logp.max(axis=1, keepdims=True))
    base = float(weights @ logp.max(axis=1))
    while len(chosen) < logp.shape[1]:
        rest = [k for k in range(logp.shape[1]) if k not in chosen]
        now = shifted[:, chosen] @ share
        # the language whose share, grown from nothing, would raise the likelihood most
        gain = [(weights / now) @ shifted[:, k] for k in rest]
        if max(gain) <= total:
            break
        trial = [*chosen, rest[int(np.argmax(gain))]]
        p = shifted[:, trial]
        pi = np.append(share * 0.7, 0.3)
        for _ in range(EM_STEPS):
            pi = pi * (p.T @ (weights / (p @ pi))) / total
        level = base + float(weights @ np.log(p @ pi))
        if level - best <= 0.5 * np.log(total + 1) + 2.0:
            break
        chosen, share, best = trial, pi, level
    return np.array(chosen), share


def beats_background(weights: np.ndarray, logp: np.ndarray, share: np.ndarray) -> bool:
    """Whether n-grams all alike do not explain the document better than its languages do."""
    most = logp.max(axis=1)
    level = float(weights @ (most + np.log(np.exp(logp - most[:, None]) @ share)))
    return level + 0.5 * np.log(weights.sum() + 1) + 2.0 > -float(weights.sum()) * np.log(BUCKETS)


def identify(docs: DataFrame, labels: list[str], model: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with lang_pred, score (the proportion of the predicted language),
    languages (the chosen set, by falling proportion) and known."""
    fields = [f for f in docs.schema.fields if f.name in keep]
    names = [f.name for f in fields]
    if "text" not in names:
        names.append("text")
    at = names.index("text")
    table = np.ascontiguousarray(model.T.astype(np.float64))

    def run(batches):
        for batch in batches:
            text = batch.column(at)
            data, offsets = column_bytes(text)
            plain = text.to_pylist()
            pred, score, sets, known = [], [], [], []
            for i, j in row_chunks(offsets):
                row, bucket = gram_buckets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                pairs, weight = np.unique(row * BUCKETS + bucket, return_counts=True)
                edge = np.searchsorted(pairs, np.arange(j - i + 1) * BUCKETS)
                for k in range(j - i):
                    t = plain[i + k]
                    part = slice(edge[k], edge[k + 1])
                    if not labels or t is None or not has_letter(t):
                        pred.append(UNKNOWN), score.append(0.0), sets.append([]), known.append(False)
                        continue
                    if edge[k] == edge[k + 1]:  # shorter than one n-gram: no evidence
                        pred.append(labels[0]), score.append(1.0 / len(labels)), sets.append([]), known.append(True)
                        continue
                    weights, logp = weight[part].astype(float), table[pairs[part] % BUCKETS]
                    chosen, share = mixture(weights, logp)
                    known.append(beats_background(weights, logp[:, chosen], share))
                    order = sorted(range(len(chosen)), key=lambda x: (-share[x], chosen[x]))
                    pred.append(labels[chosen[order[0]]])
                    score.append(float(min(1.0, max(0.0, share[order[0]]))))
                    sets.append([labels[chosen[x]] for x in order])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(fields))), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(sets, pa.list_(pa.string())), pa.array(known, pa.bool_())], names=[*(f.name for f in fields), "lang_pred", "score", "languages", "known"])

    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("languages", T.ArrayType(T.StringType())), T.StructField("known", T.BooleanType())])
    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)


def held_out() -> Column:
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 0


def trained(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Model of the labelled rows that are not held out."""
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return train(rows.filter(~F.coalesce(held_out(), F.lit(False))))


def predict_all(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict every row: doc_id, held_out, lang_pred,
    score, languages."""
    rows = docs.select("doc_id", "text", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    return identify(rows, *trained(docs), ("doc_id", "held_out")).drop("known")


def classify(docs: DataFrame) -> DataFrame:
    """``docs`` with lang_pred, score, languages and known (columns of those names are replaced)."""
    rows = docs.drop("lang_pred", "score", "languages", "known")
    return identify(rows, *trained(docs), tuple(rows.columns))
