"""Operators 4, 8 and 9, row by row against plain versions that follow their definitions with Python integers and
loops, the hashes included."""

import math
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import brute
from cases import empty, messy  # noqa: F401
from tickwise.llm import fingerprints, langid, quality

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def word_hash(word, seen={}):
    if word not in seen:
        power, total = 1, 0
        for byte in word.encode():
            total = (total + (byte + 1) * power) & MASK
            power = (power * 0x9E3779B97F4A7C15) & MASK
        seen[word] = mix(total)
    return seen[word]


def run_hash(words):
    out = len(words)
    for w in words:
        out = (out * 0xD6E8FEB86659FD93 + word_hash(w)) & MASK
    return mix(out)


def spark_hash(*values):
    """Spark's xxhash64 of an int followed by longs; nulls are passed over."""
    seed = 42
    for kind, v in zip("<i <q <q".split(), values):
        if v is not None:
            seed = xxhash.xxh64(struct.pack(kind, v), seed=seed).intdigest()
    return seed


@pytest.fixture(scope="module")
def both(spark, messy):
    """Documents of the small tables and the odd rows, whose ids are moved behind them but for three that repeat."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = messy.select(F.when(F.col("doc_id") > 3, F.col("doc_id") + 10 ** 9).otherwise(F.col("doc_id")).alias("doc_id"), "text", "lang")
    return docs.unionByName(odd).repartition(5)


# ---------------------------------------------------------------- 4
def plain_quality(rows, good, share, most):
    """{(doc_id, n_grams): (log_weight, key, kept)}"""
    target = set(sorted((i for i in good if i is not None), key=lambda i: (spark_hash(quality.SEED, i) - (1 << 64) * (spark_hash(quality.SEED, i) >> 63), i))[:most])
    features = []
    for doc, text in rows:
        words = brute.WORD.findall((text or "").translate(brute.LOWER))
        features.append([word_hash(w) % quality.BUCKETS for w in words] + [run_hash(p) % quality.BUCKETS for p in zip(words, words[1:])])
    raw, aim = Counter(), Counter()
    for (doc, _), f in zip(rows, features):
        raw.update(f)
        if doc in target:
            aim.update(f)
    s, n = quality.SMOOTHING, quality.BUCKETS
    all_raw, all_aim = sum(raw.values()) + s * n, sum(aim.values()) + s * n
    out = []
    for (doc, _), f in zip(rows, features):
        weight = sum(math.log((aim[b] + s) / all_aim) - math.log((raw[b] + s) / all_raw) for b in f) / math.sqrt(max(1, len(f)))
        u = ((spark_hash(quality.SEED, doc, len(f)) >> 11) + 0.5) / (1 << 53)
        out.append((weight - math.log(-math.log(u)), doc, len(f), weight))
    order = sorted(out, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    k = round(len(rows) * share)
    edge = order[k - 1][:2] if k else None
    kept = {r[:3] for r in order[:k]} | {r[:3] for r in out if r[:2] == edge}
    return {(doc, n): (weight, key, (key, doc, n) in kept) for key, doc, n, weight in out}


@pytest.mark.parametrize("share, most", [(0.85, 20_000), (0.3, 20)])
def test_quality_equals_plain_version(spark, both, monkeypatch, share, most):
    monkeypatch.setattr(quality, "TARGET_ROWS", most)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (10 ** 9 + 5, 1), (4, None)], "doc_id long, quality int"))
    want = plain_quality([(r["doc_id"], r["text"]) for r in both.collect()], {r["doc_id"] for r in labels.filter("quality = 1").collect()}, share, most)
    got = quality.select_quality(both, labels, share).collect()
    assert len(got) == both.count()
    for r in got:
        weight, key, kept = want[r["doc_id"], r["n_grams"]]
        assert r["log_weight"] == pytest.approx(weight, abs=1e-8) and r["key"] == pytest.approx(key, abs=1e-8) and r["kept"] == kept
    assert {r["kept"] for r in got} == {True, False}


# ---------------------------------------------------------------- 8
def plain_grams(text):
    folded = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in (text or "").encode())
    grams = (folded[i:i + 4] for i in range(len(folded) - 3))
    return Counter(mix(int.from_bytes(g)) % langid.BUCKETS for g in grams if g != b"    ")


def is_held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0


def plain_model(rows):
    counts = defaultdict(Counter)
    for doc, text, lang in rows:
        if text is not None and lang is not None and not is_held_out(doc):
            counts[lang].update(plain_grams(text))
    model = {}
    for lang in sorted(counts):
        total = sum(counts[lang].values()) + langid.SMOOTHING * langid.BUCKETS
        model[lang] = lambda b, c=counts[lang], t=total: (c[b] + langid.SMOOTHING) / t
    return model


def plain_mixture(text, model):
    """(prediction, its proportion, languages by falling proportion)"""
    if text is None or not any(c.isalpha() for c in text) or not model:
        return "und", 0.0, []
    grams = plain_grams(text)
    if not grams:
        return min(model), 1 / len(model), []
    total = sum(grams.values())
    p = {lang: {b: f(b) for b in grams} for lang, f in model.items()}
    level_of = lambda mix_: sum(n * math.log(sum(s * p[x][b] for x, s in mix_.items())) for b, n in grams.items())
    first = max(sorted(p), key=lambda x: level_of({x: 1.0}))
    chosen, best = {first: 1.0}, level_of({first: 1.0})
    while len(chosen) < len(p):
        now = {b: sum(s * p[x][b] for x, s in chosen.items()) for b in grams}
        gain = {x: sum(n * p[x][b] / now[b] for b, n in grams.items()) for x in sorted(p) if x not in chosen}
        new = max(gain, key=gain.get)
        if gain[new] <= total:
            break
        trial = {x: 0.7 * s for x, s in chosen.items()} | {new: 0.3}
        for _ in range(langid.EM_STEPS):
            part = {b: sum(s * p[x][b] for x, s in trial.items()) for b in grams}
            trial = {x: s * sum(n * p[x][b] / part[b] for b, n in grams.items()) / total for x, s in trial.items()}
        if level_of(trial) - best <= 0.5 * math.log(total + 1) + 2.0:
            break
        chosen, best = trial, level_of(trial)
    order = sorted(chosen, key=lambda x: (-chosen[x], x))
    return order[0], min(1.0, chosen[order[0]]), order


def test_languages_equal_plain_version(spark, both):
    mixed = both.filter("lang IS NOT NULL AND length(text) > 400").limit(12).collect()
    joined = [(2 * 10 ** 9 + i, a["text"][:400] + " " + b["text"][-300:], None) for i, (a, b) in enumerate(zip(mixed, mixed[1:]))]
    docs = both.union(spark.createDataFrame([*joined, (3 * 10 ** 9, "ab", None)], both.schema))
    rows = [tuple(r) for r in docs.collect()]
    model = plain_model(rows)
    want = {(doc, text): plain_mixture(text, model) for doc, text, _ in set(rows)}
    got = langid.predict_all(docs).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(list)
    for (doc, _), w in want.items():
        by_id[doc].append(w)
    for r in got:
        assert r["held_out"] == is_held_out(r["doc_id"])
        assert any(r["lang_pred"] == pred and r["score"] == pytest.approx(score, abs=1e-8) and r["languages"] == langs for pred, score, langs in by_id[r["doc_id"]])
    assert max(len(r["languages"]) for r in got) > 1


# ---------------------------------------------------------------- 9
def plain_sketch(text):
    words = brute.WORD.findall(text)
    runs = [words[i:i + 5] for i in range(len(words) - 4)] if len(words) >= 5 else [words] if words else []
    whole = {run_hash(r) for r in runs}
    return whole, {h for h in whole if h < (1 << 64) // fingerprints.SCALE}


def plain_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    least = min(len(a[1]), len(b[1]))
    return len(a[1] & b[1]) / least if least else 0.0


def test_likeness_equals_plain_version(both):
    data = sorted(((r["doc_id"], r["text"] or "") for r in both.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for i, (doc, text) in enumerate(data):
        after = data[(i + 1) % len(data)][1]
        q = len(text) // 4
        own, edited, following = plain_sketch(text), plain_sketch(text[:len(text) - q] + after[:q]), plain_sketch(after)
        want.append((doc or -1, len(text), len(own[0]), len(edited[0]), plain_likeness(own, edited), plain_likeness(own, following)))
    got = [(r["doc_id"] or -1, r["n_chars"], int(r["fingerprint"].split(":")[0]), int(r["edited_fingerprint"].split(":")[0]), r["near_edited"], r["near_next"])
           for r in fingerprints.compare_with_next(both).collect()]
    assert sorted(got) == sorted(want)
