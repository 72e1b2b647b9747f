"""Operators 11 to 13 against plain versions, and on rows that are easily forgotten."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cases import empty, messy, rows  # noqa: F401
from tickwise.llm import packing, rotated_codes, segment_resampling, token_alignment

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- 11
def brute_nearest(data, wanted, k=10):
    """{(query id, vector): [(distance, id)]} over valid rows, pairs once."""
    good = sorted({(i, tuple(v)) for i, v in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = {}
    for i, v in good:
        if wanted(i):
            d = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), j) for j, w in good if j != i and len(w) == len(v))
            out[i, v] = d[:k]
    return out


def vectors(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("d", F.lit("x")).withColumn("list", F.lit(1)).repartition(3)


def got_nearest(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    return {q: [(s, i) for _, s, i in sorted(v)] for q, v in out.items()}


def test_code_estimates_stay_within_their_bounds():
    rng = np.random.RandomState(1)
    x, q, turn = rng.standard_normal((3000, 24)), rng.standard_normal((20, 24)), rotated_codes.rotation(24)
    assert np.allclose(turn.T @ turn, np.eye(24))
    near, code, norm, fit = rotated_codes.encode(x, np.zeros((1, 24)), turn)
    signs = np.unpackbits(code, axis=1) * 2.0 - 1
    unit = q / np.linalg.norm(q, axis=1)[:, None]
    estimate = unit @ turn.T @ signs.T / np.sqrt(turn.shape[0]) / fit
    error = rotated_codes.EPSILON / np.sqrt(turn.shape[0] - 1) * np.sqrt(1 - fit ** 2) / fit
    true = unit @ (x / norm[:, None]).T
    assert (np.abs(estimate - true) <= error).mean() > 0.97
    assert abs((estimate - true).mean()) < 0.005


def test_recall_against_brute_force(spark):
    data = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = {i: d for (i, _), d in brute_nearest(data, lambda i: i % 100 == 0).items()}
    docs = spark.read.parquet(f"{SF}/embeddings.parquet")
    for list_rows in (rotated_codes.LIST_ROWS, 25):
        got = got_nearest(rotated_codes.nearest(docs, F.col("id") % 100 == 0, list_rows=list_rows))
        assert set(got) == set(want) and all(len(got[i]) == len(want[i]) for i in want)
        hits = sum(len({j for _, j in got[i]} & {j for _, j in want[i]}) for i in want)
        assert hits >= 0.9 * sum(map(len, want.values()))
        for i, found in got.items():
            v = np.array(dict(data)[i], float)
            assert found == sorted(found)
            for d, j in found:
                assert d == pytest.approx(np.sqrt(((np.array(dict(data)[j], float) - v) ** 2).sum()), rel=1e-12)


def test_odd_vectors_copies_and_lengths(spark):
    rng = np.random.RandomState(3)
    base = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    odd = [(None, [1.0] * 8), (300, None), (400, [0.0] * 8), (500, [None] + [1.0] * 7), (600, [float("nan")] * 8), (700, [float("inf")] * 8), (800, [])]
    copies = [(1000 + i, [0.5] * 8) for i in range(50)] + [(1000, [0.5] * 8)] * 5
    short = [(2000, [1.0, 2.0]), (2001, [1.5, 2.0]), (2002, [9.0, 2.0])]
    twice = [(100, base[3][1]), (100, base[4][1])]
    data = base + odd + copies + short + twice
    for most in (rotated_codes.LIST_ROWS, 20):
        got = rotated_codes.nearest(vectors(spark, data), F.col("id") % 100 == 0, recall=1.0, list_rows=most).collect()
        want = brute_nearest(data, lambda i: i % 100 == 0)
        flat = sorted((i, r + 1, j, round(d, 9)) for (i, _), found in want.items() for r, (d, j) in enumerate(found))
        assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == flat
    assert rotated_codes.nearest(vectors(spark, data).limit(0), F.col("id") % 100 == 0).collect() == []


def test_blocks_and_chunks_do_not_change_results(spark, monkeypatch):
    rng = np.random.RandomState(4)
    data = vectors(spark, [(i, rng.standard_normal(6).tolist()) for i in range(400)])
    plain = got_nearest(rotated_codes.nearest(data, F.col("id") % 4 == 0, recall=1.0))
    monkeypatch.setattr(rotated_codes, "BLOCK", 50)
    monkeypatch.setattr(rotated_codes, "CHUNK", 20)
    assert got_nearest(rotated_codes.nearest(data, F.col("id") % 4 == 0, recall=1.0)) == plain


# ---------------------------------------------------------------- 12
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute_resample(docs, target):
    S, T = Counter(), Counter()
    for _, t in docs:
        S.update(features(t)[1])
    for t in target:
        T.update(features(t)[1])
    s_all, t_all = sum(S.values()), sum(T.values())
    gain = {b: math.floor(1000 * math.log((T[b] + 1) * (s_all + 10000) / ((S[b] + 1) * (t_all + 10000)))) for b in range(10000)}
    out = []
    for doc, t in docs:
        w, f = features(t)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = Counter()
    for place, r in enumerate(able[:25 * len(able) // 100]):
        drawn[r[0], r[2], place + 1] += 1
    return Counter((r[0], *r[2:]) for r in out), drawn


def check_resample(docs, target):
    got = segment_resampling.resample(docs, target).collect()
    want, drawn = brute_resample([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in target.collect()])
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == want
    assert Counter((r["doc_id"], r["n_features"], r["rank"]) for r in got if r["rank"] is not None) == drawn


def test_resample_equals_plain_version(spark):
    check_resample(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet").select("text"))


def test_resample_odd_rows(spark, messy, empty):
    target = spark.createDataFrame([(None,), ("",), ("one two three\nfour five",)], "text string")
    lines = rows(spark, [(i, "\r\n".join(["same line of words"] * 4 + [f"own{i} word"] + ["\n", " tail é" + "x" * 200 + " A\x00b"]) * (1 + i % 3), "en", "a") for i in range(40)])
    for docs in (messy, lines, messy.select("doc_id", "text").unionByName(lines.select("doc_id", "text"))):
        check_resample(docs, target)
    check_resample(lines, target.limit(0))
    assert segment_resampling.resample(empty, target).collect() == []


def test_crc_of_spans():
    rng = np.random.RandomState(2)
    raw = [bytes(rng.randint(97, 123, n).astype(np.uint8)) for n in [1, 2, 5, 47, 48, 49, 200, 3]]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    end = np.cumsum([len(r) + 1 for r in raw]) - 1
    got = segment_resampling.registers(data, end - [len(r) for r in raw], end) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(r) for r in raw]


# ---------------------------------------------------------------- 13
def byte_alphabet():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b if b in plain else 256 + sum(c not in plain for c in range(b))): b for b in range(256)}


def brute_align(texts):
    """Per text (n_a, n_b, n_groups, links, digest), token by token."""
    import public_tokenizers as p
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(p.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=p.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    alphabet = byte_alphabet()

    def piece(i):
        s = b.id_to_piece(i)
        return bytes([int(s[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", s) else s.replace("▁", " ").encode()

    out = []
    for text in texts:
        ta = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
        tb = [(i, piece(i)) for i in b.encode(text)] if text else []
        want = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in ta) != want or b"".join(x for _, x in tb) != want:
            out.append((0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for _, x in ta]), np.cumsum([len(x) for _, x in tb])
        links = [(ta[i][0], tb[j][0]) for i in range(len(ta)) for j in [np.searchsorted(ends_b, ends_a[i])] if ends_b[j] == ends_a[i]]
        groups, at = [], 0
        for c in sorted(set(ends_a) & set(ends_b)):
            pick = lambda ts, es: ",".join(str(t[0]) for t, e in zip(ts, es) if at < e <= c)  # noqa: B023, E731
            groups.append(pick(ta, ends_a) + "|" + pick(tb, ends_b))
            at = c
        out.append((len(ta), len(tb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def check_alignment(df, **kw):
    got = token_alignment.alignment(df, **kw).collect()
    data = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    plain = brute_align([t for _, t in data])
    count = Counter(p for r in plain for p in r[3])
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    want = Counter((doc, na, nb, ng, len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links), sha)
                   for (doc, _), (na, nb, ng, links, sha) in zip(data, plain))
    assert Counter(tuple(r) for r in got) == want
    return want


def test_alignment_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("n_chars").limit(300)
    want = check_alignment(docs)
    assert check_alignment(docs.repartition(5), block_links=500) == want
    assert sum(r[1] > 0 for r in want) > 200


def test_alignment_odd_rows(spark, messy, empty):
    extra = rows(spark, [(20, "<|endoftext|> <s> </s> <0x41>", "en", "a"), (21, "two  spaces", "en", "a"), (22, " lead", "en", "a"), (23, "▁low", "en", "a"),
                         (24, "日本語 \U0001f600 café", "ja", "b"), (25, "a\x00b", "en", "a"), (26, "tail ", "en", "a"), (27, "ﬁne", "en", "a")])
    check_alignment(extra)
    check_alignment(messy.filter(F.coalesce(F.length("text"), F.lit(0)) < 1000))
    assert token_alignment.alignment(empty).collect() == []
    long = messy.filter(F.length("text") > 1000).select("doc_id", "text")
    got = token_alignment.alignment(long).collect()
    assert len(got) == 2 and got[0]["groups_sha256"] == got[1]["groups_sha256"] != "" and got[0]["n_a"] > 60_000


def test_token_bytes_of_both_files():
    import public_tokenizers as p
    alphabet = byte_alphabet()
    vocab = json.load(open(p.path("byte_bpe_50k.json")))["model"]["vocab"]
    tokens = packing.Encoder(packing.default_vocabulary()).tokens()
    for token, i in vocab.items():
        if i in tokens:
            assert bytes(alphabet[c] for c in token) == tokens[i]


def test_used_encoders_still_travel(spark, messy):
    encode, words = packing.Encoder(packing.default_vocabulary()), token_alignment.Vocabularies(token_alignment.default_paths())
    assert len(encode("some words")) and words.b.vocab_size() and len(words.lists_a(["x"]))
    for used in (encode, words):
        again = cloudpickle.loads(cloudpickle.dumps(used))
        assert again.paths == used.paths and len(cloudpickle.dumps(used)) < 10_000
    packing.tokenise(messy.limit(3), packing.default_vocabulary()).collect()
    assert packing.pack(messy).count() > 0
