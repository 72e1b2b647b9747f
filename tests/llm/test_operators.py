"""The operators against plain versions on small tables, and on rows that are easily forgotten."""

import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from cases import LONG, empty, messy, rows  # noqa: F401
from tickwise.llm import exact_dedup, fingerprints, langid, line_dedup, mixing, ngram_join, packing, quality, secret_scan, suffix_dedup
from tickwise.llm.components import components
from tickwise.llm.text import row_shingles, strings_bytes, word_hashes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ---------------------------------------------------------------- words
def test_word_hashes_follow_the_word_pattern():
    texts = ["", " ", "a", "a b", "b a", "été naïve", "x\x1fy z", "a b", LONG, "tail"]
    words, start, end, first = word_hashes(*strings_bytes(texts))
    for i, t in enumerate(texts):
        assert first[i + 1] - first[i] == len(brute.WORD.findall(t))
    assert (words[first[3]:first[4]] == words[first[7]:first[8]]).all()
    sets = [set(s.tolist()) for s in row_shingles(words, first, 3)]
    assert [len(s) for s in sets] == [len(brute.shingles(t, lower=False)) for t in texts]


# ---------------------------------------------------------------- 1
def check_components(df):
    want = brute.jaccard_components(pairs(df))
    got = ngram_join.jaccard_components(df).collect()
    texts = {(r["doc_id"], r["h"]): r["text"] for r in df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    assert len(got) == df.count()
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"], texts[r["doc_id"], r["text_hash"]]]


def near_copies(n, words, seed=1):
    """Chains and stars around several base texts, many of them close to the threshold."""
    rng = np.random.RandomState(seed)
    out = []
    for i in range(n):
        base = [f"b{i % 3}w{k}" for k in range(words)]
        for _ in range(rng.randint(0, max(2, words // 25))):
            base[rng.randint(words)] = f"e{rng.randint(10 ** 6)}"
        out.append((i, " ".join(base), "en", "s"))
    return out


@pytest.mark.parametrize("words", [9, 12, 21, 60, 200])
def test_near_copies_link_as_in_brute_force(spark, words):
    check_components(rows(spark, near_copies(150, words)))


def test_large_cluster_is_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    check_components(rows(spark, near_copies(150, 60, seed=2)))


def test_jaccard_on_messy_and_empty(messy, empty):
    check_components(messy)
    assert ngram_join.jaccard_components(empty).count() == 0


def test_long_sets_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 500)
    check_components(rows(spark, near_copies(120, 60, seed=4) + [(i + 200, t, lang, s) for i, t, lang, s in near_copies(30, 700, seed=5)]))


@pytest.mark.parametrize("num, den", [(9, 10), (8, 10), (1, 2)])
def test_block_links_join_what_all_pairs_join(num, den):
    rng = np.random.RandomState(num)
    for size in (1, 2, 5, 20, 300):
        bases = [rng.randint(0, 2 ** 62, size).astype(np.uint64) for _ in range(3)]
        sets = []
        for k in range(60):
            own = bases[k % 3].copy()
            own[rng.randint(0, size, rng.randint(0, max(1, size // 3) + 1))] = rng.randint(0, 2 ** 62)
            sets.append(np.unique(own[:rng.randint(max(1, size - 4), size + 1)]))
        names = [1000 + k for k in range(len(sets))]
        links = ngram_join.block_links(names, sets, num=num, den=den)
        want = {(a, b) for a, b in itertools.combinations(range(60), 2)
                if den * len(np.intersect1d(sets[a], sets[b])) >= num * len(np.union1d(sets[a], sets[b]))}
        assert all(tuple(sorted((u - 1000, v - 1000))) in want for u, v in links)

        def groups(pairs):
            label = list(range(60))
            for a, b in pairs:
                label = [label[a] if x == label[b] else x for x in label]
            return {frozenset(i for i in range(60) if label[i] == x) for x in label}

        assert groups((u - 1000, v - 1000) for u, v in links) == groups(want)


def test_two_long_copies_share_one_run():
    whole = np.arange(400_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sets = [np.sort(whole), np.sort(whole[:-3]), np.sort(whole[5:])]
    assert len(ngram_join.block_links([1, 2, 3], sets)) == 2


def test_keep_one_keeps_the_smallest_id(spark):
    df = rows(spark, near_copies(60, 60))
    want = {c for _, c in brute.jaccard_components(pairs(df)).values()}
    assert sorted(r["doc_id"] for r in ngram_join.keep_one(df).collect()) == sorted(want)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(-5, 100), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: -5 for i in [-5, *range(100, 140)]}


# ---------------------------------------------------------------- 2
def check_secrets(df):
    got = secret_scan.digest(secret_scan.scan(df)).collect()
    want = {}
    for doc, text in pairs(df):
        counts, sha, spans = brute.secrets(text)
        want.setdefault(doc, []).append((*counts, sha))
        for r in got:
            if r["doc_id"] == doc and r["base_sha256"] == sha:
                assert set(spans) <= set(r["spans"].split(",")) | {""}
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append((r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_secrets_on_all_documents(docs):
    check_secrets(docs)


def test_secrets_on_messy_empty_and_traps(spark, messy, empty):
    check_secrets(messy)
    assert secret_scan.scan(empty).count() == 0
    traps = ["token = ab:password=abcdef", "PassWord\"  :  'x1y2z3", "toKen=abcdefgh", "api-key=abcdefg apikey=abcdefg API_KEY:abcdefg",
             "AKIA" + "A" * 15, "AKIAAKIA" + "A" * 12, "f" * 23 + "g" + "0" * 24, "\U0001f600 secret=======", "ghp_" + "a1" * 18,
             "-----BEGIN RSA PRIVATE KEY-----", "xoxb-123456789012", "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh12"]
    df = rows(spark, [(i, t, "en", "s") for i, t in enumerate(traps)])
    check_secrets(df)
    kinds = {r["doc_id"]: {s["kind"] for s in r["found"]} for r in secret_scan.scan(df).collect()}
    assert kinds[8] >= {"github"} and kinds[9] == {"private"} and kinds[10] == {"slack"} and kinds[11] == {"jwt"}


def test_trigram_query_is_implied_by_matches():
    texts = ["my token: abcdef", "api_key=1", "apikey=1", "AKIA" + "Z" * 16, "no such thing", "gho_" + "x" * 36, "-----BEGIN PRIVATE KEY-----"]
    for rule in secret_scan.RULES:
        query = secret_scan.trigram_query(rule.pattern)
        hits = set(secret_scan.Segment(texts, secret_scan.query_grams(query)).search(query).tolist())
        assert {i for i, t in enumerate(texts) if re.search(rule.pattern, t)} <= hits
    assert secret_scan.trigram_query("[0-9a-f]+") is True
    kind, parts = secret_scan.trigram_query("abc?d")
    assert kind == "or" and set(parts) == {("and", frozenset({"abd"})), ("and", frozenset({"abc", "bcd"}))}


# ---------------------------------------------------------------- 3
def check_mix(df):
    got = mixing.mix_by_source(df).collect()
    assert len(got) == df.count()
    by = {}
    for r in got:
        assert r["taken"] == r["size"] * r["repeats"] and 0 <= r["taken"] <= 3 * r["size"]
        s = by.setdefault(r["source"], [0, 0, 0, r["source_size"], r["target"]])
        s[0] += r["size"]
        s[1] += r["taken"]
        s[2] = max(s[2], r["size"])
    names = sorted(by, key=lambda s: (s is None, s or ""))
    want = mixing.capped_targets([by[s][0] for s in names], [1 + i % 3 for i in range(len(names))])
    for s, t in zip(names, want):
        total, taken, longest, size, target = by[s]
        assert total == size and math.isclose(target, t, rel_tol=1e-9, abs_tol=1e-6)
        assert abs(taken - target) <= max(0.02 * target, longest if total < 20 * longest else 0) + 1
    return {(r["doc_id"], r["taken"]) for r in got}


def test_mix_meets_targets_and_repeats(docs):
    assert check_mix(docs) == check_mix(docs.repartition(5))


def test_mix_on_messy_and_empty(messy, empty):
    check_mix(messy)
    assert mixing.mix_by_source(empty).count() == 0


def test_capped_targets_share_the_excess():
    assert mixing.capped_targets([10, 100, 100], [1, 1, 1]) == [30.0, 90.0, 90.0]
    assert mixing.capped_targets([0, 5], [1, 2]) == [0.0, 5.0]
    assert mixing.capped_targets([], []) == []


def test_flow_spreads_repetition_over_overlapping_sources():
    # a: only source 0; b: both; c: only source 1. Source 0 needs twice what a holds.
    flow = mixing.min_cost_flow([10, 10, 10], [[0], [0, 1], [1]], [20, 10], 3)
    assert [sum(f.values()) for f in flow] == [10, 10, 10]
    assert flow[0][0] + flow[1][0] == 20 and flow[2][1] == 10
    deep = mixing.min_cost_flow([10, 10], [[0], [0]], [40], 3)
    assert [sum(f.values()) for f in deep] == [20, 20]
    assert sum(mixing.min_cost_flow([10], [[0]], [100], 3)[0].values()) == 30


def test_mix_with_overlapping_members(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("CASE id % 3 WHEN 0 THEN array('a') WHEN 1 THEN array('a', 'b') ELSE array('b', CAST(NULL AS STRING)) END").alias("m"))
    out, targets = mixing.mix(df, F.col("m"), F.lit(10).cast("long"), weights=lambda names: [2 if n == "a" else 1 for n in names])
    assert set(targets) == {"a", "b", None}
    assert out.agg(F.max("repeats")).first()[0] <= 3 and out.count() == 400


# ---------------------------------------------------------------- 4
def test_quality_prefers_labelled_good_text(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.select_quality(docs, labels)
    out = got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()
    share = {r["quality"]: r["k"] for r in out}
    assert share[1] > 0.9 and share[0] < 0.4
    n = docs.count()
    assert got.filter("kept").count() == round(n * quality.KEEP_SHARE)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in quality.select_quality(docs.repartition(3), labels).collect()}


def test_kth_key_narrows_to_the_exact_row(spark, monkeypatch):
    monkeypatch.setattr(quality, "EDGE_ROWS", 50)
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(700)).cast("double")).alias("key"))
    order = sorted(((-r["key"], r["doc_id"]) for r in df.collect()))
    for k in (1, 2500, 4999, 5000):
        assert quality.kth_key(df, k) == (-order[k - 1][0], order[k - 1][1])
    assert quality.kth_key(df, 0) is None


def test_quality_on_messy_and_empty(spark, messy, empty):
    labels = spark.createDataFrame([(4, 1, 0), (None, None, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality.select_quality(messy, labels).count() == messy.count()
    assert quality.select_quality(empty, labels.limit(0)).count() == 0


# ---------------------------------------------------------------- 5
def check_exact(df):
    data = pairs(df)
    norm = {r: re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in data}
    got = exact_dedup.exact_duplicates(df).collect()
    assert len(got) == len(data)
    groups = {}
    for r in data:
        groups.setdefault(norm[r], []).append(r)
    sha = {hashlib.sha256(n.encode()).hexdigest(): n for n in groups}
    for r in got:
        group = groups[sha[r["text_sha256"]]]
        best = min(group, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))
        assert r["group_size"] == len(group) and r["keep_id"] == best[0]
    assert sum(r["kept"] for r in got) >= len(groups)


def test_exact_on_messy_empty_and_spacing(spark, messy, empty):
    check_exact(messy)
    assert exact_dedup.exact_duplicates(empty).count() == 0
    check_exact(rows(spark, [(1, "a b c", None, None), (2, "abc ", None, None), (3, "a  b c", None, None), (4, "\tabc\n\n\n", None, None), (5, LONG.replace(" ", "\n"), None, None), (6, LONG, None, None)]))


def test_chunks_join_and_resynchronise(spark):
    df = spark.createDataFrame([(LONG,), ("inserted at the front " + LONG,)], "text string").select(exact_dedup.normalised(F.col("text")).alias("n"))
    a, b = df.select("n", exact_dedup.chunks(F.col("n")).alias("c")).collect()
    assert "".join(a["c"]) == a["n"] and "".join(b["c"]) == b["n"]
    assert len(set(a["c"]) & set(b["c"])) > 0.8 * len(set(a["c"]))


# ---------------------------------------------------------------- 6
def test_lines_on_messy_empty_and_planted(spark, messy, empty):
    block = "first line\nsecond line\nthird line\nfourth line"
    planted = rows(spark, [(1, block, "en", "a"), (2, "head\n\n " + block + " \ntail", "en", "a"), (3, "second line\nthird line", "en", "a"), (4, block + "\n" + block, "en", "b"),
                           (5, "\n\n\n", "en", "b"), (6, "first line\nsecond line\nother\nthird line", "en", "b")])
    for df in (messy, planted):
        want = brute.line_windows(pairs(df))
        for r in df.select("doc_id", F.col("text").alias("before"), "text").join(line_dedup.remove_lines(df).select("doc_id", F.col("text").alias("after")), "doc_id").collect():
            assert r["after"] in {want[k] for k in want if k[0] == r["doc_id"]}
        assert line_dedup.remove_lines(df).count() == df.count()
    assert line_dedup.remove_lines(empty).count() == 0


# ---------------------------------------------------------------- 7
def brute_repeats(data, least=50):
    """Words of each document that lie in a passage of ``least`` words found in another document."""
    seen, words = {}, {}
    for doc, text in data:
        w = brute.WORD.findall(text or "")
        words[doc] = w
        for i in range(len(w) - least + 1):
            seen.setdefault(tuple(w[i:i + least]), set()).add(doc)
    out = {}
    for doc, w in words.items():
        hit = set()
        for i in range(len(w) - least + 1):
            if len(seen[tuple(w[i:i + least])]) > 1:
                hit |= set(range(i, i + least))
        out[doc] = hit
    return out


def check_repeats(df):
    data = pairs(df)
    want = brute_repeats(data)
    texts = dict(data)
    for r in suffix_dedup.repeated_passages(df).collect():
        spans = [(s["start"], s["end"]) for s in r["repeats"]]
        got = {i for i, m in enumerate(brute.WORD.finditer(texts[r["doc_id"]] or "")) if any(a <= m.start() and m.end() <= b for a, b in spans)}
        assert got == want[r["doc_id"]], r["doc_id"]
        assert all(any(a <= s["start"] and s["end"] <= b for a, b in spans) for s in r["removed"])


def test_repeats_match_brute_force(docs):
    check_repeats(docs.limit(400))


def test_repeats_of_planted_passages(spark):
    rng = np.random.RandomState(5)
    noise = lambda n: " ".join(f"n{rng.randint(10 ** 9)}" for _ in range(n))
    passages = {n: " ".join(f"p{n}x{i}" for i in range(n)) for n in (49, 50, 51, 60, 120)}
    data = [(i, f"{noise(rng.randint(60))}\n{passages[n]} {noise(rng.randint(60))}", "en", "s") for i, n in enumerate([49, 50, 51, 60, 120] * 8)]
    check_repeats(rows(spark, data))
    out = {r["doc_id"]: r for r in suffix_dedup.repeated_passages(rows(spark, data)).collect()}
    assert all((not out[i]["removed"]) == (i < 5 or i % 5 == 0) for i in out)


def test_repeats_on_messy_and_empty(messy, empty):
    assert suffix_dedup.repeated_passages(messy).count() == messy.count()
    assert suffix_dedup.repeated_passages(empty).count() == 0


# ---------------------------------------------------------------- 8
def test_languages_are_predicted_from_text_alone(docs):
    got = langid.predict_all(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_mixture_finds_both_languages(docs):
    labels, model = langid.trained(docs)
    by = {r["lang"]: r["text"] for r in docs.filter("length(text) > 3000").dropDuplicates(["lang"]).collect()}
    text = by["en"][:2500] + " " + by["de"][:1500]
    out = langid.identify(docs.sparkSession.createDataFrame([(1, text)], "doc_id long, text string"), labels, model).first()
    assert out["languages"] == ["en", "de"] and 0.5 < out["score"] < 0.75


def test_languages_on_messy_and_empty(messy, empty):
    got = {r["doc_id"]: r for r in langid.predict_all(messy).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 3, 12))
    assert langid.predict_all(empty).count() == 0
    assert langid.classify(messy).columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


# ---------------------------------------------------------------- 9
def check_next(df):
    got = sorted(fingerprints.compare_with_next(df).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    data = sorted(pairs(df), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(data)
    by_text = {}
    for i, ((doc, text), r) in enumerate(zip(data, got)):
        text, after = text or "", data[(i + 1) % len(data)][1] or ""
        q = len(text) // 4
        assert r["doc_id"] == doc and r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256((text[:len(text) - q] + after[:q]).encode()).hexdigest()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    return data, got


def test_fingerprints_of_all_documents(docs):
    data, got = check_next(docs)
    errors = []
    for i, r in enumerate(got):
        text, after = data[i][1], data[(i + 1) % len(data)][1]
        a, b = brute.shingles(text, 5, False), brute.shingles(text[:len(text) - len(text) // 4] + after[:len(text) // 4], 5, False)
        if min(len(a), len(b)) >= 200:
            errors.append(r["jaccard_edited"] - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08
    assert np.mean([r["near_edited"] > r["near_next"] for r in got if r["n_chars"] > 300]) > 0.99


def test_fingerprints_on_messy_empty_and_one(spark, messy, empty):
    check_next(messy)
    assert fingerprints.compare_with_next(empty).count() == 0
    check_next(rows(spark, [(1, "a single row", "en", "s")]))
    out = fingerprints.fingerprint(messy)
    assert out.columns == [*(c for c in messy.columns if c != "fingerprint"), "fingerprint"]


def test_sketches_merge():
    a, b = (fingerprints.sketch(np.arange(s, s + 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in (0, 4000))
    union = fingerprints.sketch(np.arange(0, 9000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert (np.union1d(a[1], b[1]) == union[1]).all()
    assert abs(fingerprints.likeness(a, union) - 1) < 1e-9 and abs(fingerprints.jaccard(a, b) - 1000 / 9000) < 0.03


# ---------------------------------------------------------------- 10
def check_packing(df, **options):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_vocabulary()[1])
    tok.encode_special_tokens = True
    got = packing.pack(df, **options).collect()
    want = {}
    for doc, text in pairs(df):
        want.setdefault(doc, []).append([*tok.encode(text or "", add_special_tokens=False).ids, 0])
    sequences, docs_ = {}, {}
    for r in got:
        assert 1 <= r["length"] <= 1024
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs_.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    total = 0
    for spans in sequences.values():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end == 1024 or end & (end - 1) == 0
        total += end
    assert total == sum(len(ids) for v in want.values() for ids in v)
    for doc, copies in want.items():
        assert sum(n for _, n, _, _ in docs_[doc]) == sum(map(len, copies))
        if len({tuple(c) for c in copies}) == 1:
            for start, n, crc, tokens in docs_[doc]:
                assert tokens == len(copies[0]) and crc == zlib.crc32(np.array(copies[0][start:start + n], "<u4").tobytes())
    return got


def test_packing_all_documents(docs):
    got = check_packing(docs)
    # every full sequence has the sources in the proportions of the whole: a token each is carried, and
    # rounds are short by what is carried, at most one token a source, so a sequence ends in the next one
    share, held = {}, {}
    for r in got:
        share[r["source"]] = share.get(r["source"], 0) + r["length"]
        held[r["sequence_id"], r["source"]] = held.get((r["sequence_id"], r["source"]), 0) + r["length"]
    total = sum(share.values())
    apart = [abs(held.get((k, s), 0) - 1024 * n / total) for k in range(total // 1024 - 2) for s, n in share.items()]
    assert len(share) > 10 and max(apart) <= len(share) + 1 and np.mean(apart) < 1


def plain_rounds(totals, num):
    """Stream of (queue, index): round by round, whole tokens of each queue's credit."""
    given, credit, out = [0] * len(totals), [0] * len(totals), []
    while len(out) < sum(totals):
        for s, t in enumerate(totals):
            credit[s] += num[s]
            take = min(credit[s] // packing.PARTS, t - given[s])
            out += [(s, given[s] + j) for j in range(take)]
            given[s] += take
            credit[s] -= take * packing.PARTS
    return out


@pytest.mark.parametrize("totals, weights, window", [([100, 37, 1, 900], None, 64), ([50, 300, 7], [3, 1, 1], 16), ([5], None, 1024),
                                                      ([10, 0, 2000], [1, 5, 0.01], 8), ([64, 64], None, 1), ([3000, 1, 1], None, 2048)])
def test_rounds_equal_a_plain_round_robin(totals, weights, window):
    rounds = packing.Rounds(totals, weights, window, length=64)
    want = plain_rounds(totals, rounds.num.tolist())
    place = {t: i for i, t in enumerate(want)}
    ends = list(range(0, rounds.tail, 64)) + rounds.tail_starts.tolist()
    for s, n in enumerate(totals):
        for a, b in ((0, n), (n // 3, n // 2)):
            if b > a:
                assert rounds.places(s, a, b - a).tolist() == [place[s, i] for i in range(a, b)]
                for first, length, number, offset in rounds.pieces(s, a, b - a):
                    for f, m, k, o in zip(first, length, number, offset):
                        assert [place[s, a + f + j] for j in range(m)] == list(range(ends[k] + o, ends[k] + o + m))
                        assert k + 1 == len(ends) or ends[k] + o + m <= ends[k + 1]


def test_packing_with_weights_messy_and_empty(docs, messy, empty):
    check_packing(messy)
    assert packing.pack(empty).count() == 0
    sources = [r[0] for r in docs.select("source").distinct().collect()]
    got = check_packing(docs, weights={s: 1 + i % 4 for i, s in enumerate(sources)}, window=8192)
    early = {}
    for r in got:
        if r["sequence_id"] < 40:
            early[r["source"]] = early.get(r["source"], 0) + r["length"]
    weights = {s: 1 + i % 4 for i, s in enumerate(sources)}
    assert all(abs(early[s] / (40 * 1024) - w / sum(weights.values())) < 0.01 for s, w in weights.items())


def test_fast_ids_equal_the_tokenizers(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_vocabulary()[1])
    tok.encode_special_tokens = True
    encode = packing.Encoder(packing.default_vocabulary())
    for t in ["", " ", "a" * 5000, " " * 20_000 + "x", "\r\n\t  x  y", "<|endoftext|>", "'s 'S don't éé 12٣ \U0001f600‍", "\x00\x85 z"]:
        assert encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
