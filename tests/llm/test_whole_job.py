"""Cases in which an operator once did less than its whole job."""

import itertools
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from cases import rows
import corpus_pipeline as P
from tickwise.llm import langid, mixing, ngram_join, suffix_dedup

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- near copies at 5 words, J >= 0.8
def edited(words, edits, name):
    base = [f"{name}w{i}" for i in range(words)]
    other = list(base)
    for i in range(edits):
        other[(2 * i + 1) * words // (2 * edits)] = f"{name}e{i}"
    return " ".join(base), " ".join(other)


def test_stage_drops_near_copies_with_spread_edits(spark):
    pairs = [edited(200, 4, "a"), edited(100, 2, "b"), edited(500, 10, "c")]
    df = rows(spark, [(i, t, "en", "s") for i, t in enumerate(t for p in pairs for t in p)])
    assert sorted(r["doc_id"] for r in P.ngram_jaccard(spark, df, SF).collect()) == [0, 2, 4]
    assert ngram_join.keep_one(df).count() == 6     # op1 stays at three words and 0.9


@pytest.mark.parametrize("words", [7, 12, 30, 60, 200, 700])
def test_stage_on_near_copies_as_in_brute_force(spark, words):
    rng = np.random.RandomState(words)
    data = []
    for i in range(120):
        base = [f"b{i % 3}w{k}" for k in range(words)]
        for _ in range(rng.randint(0, max(2, words // 20))):
            base[rng.randint(words)] = f"e{rng.randint(10 ** 6)}"
        data.append((i, " ".join(base[rng.randint(0, 2):]), "en", "s"))
    got = P.ngram_jaccard(spark, rows(spark, data), SF).collect()
    assert sorted(r["doc_id"] for r in got) == brute.kept_of_near_copies([r[:2] for r in data])


def test_stage_on_documents_as_in_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").filter("text IS NOT NULL")
    got = P.ngram_jaccard(spark, df, SF).collect()
    assert sorted(r["doc_id"] for r in got) == brute.kept_of_near_copies([(r["doc_id"], r["text"]) for r in df.collect()])


def prefixes(spark, sets, num, den, ranges):
    """{name: keys} through the packed exchanges, without Spark."""
    names = [ngram_join.set_digest(s) for s in sets]
    by = defaultdict(list)
    for i in (0, 1):        # two tasks
        for r, heads, codes in ngram_join._pack(names[i::2], sets[i::2], ranges):
            by[r].append((heads, codes))
    found = []
    for r, parts in by.items():
        heads = np.frombuffer(b"".join(h for h, _ in parts), ngram_join._HEAD)
        d, codes, held = ngram_join._shared_codes(heads, np.frombuffer(b"".join(c for _, c in parts), "<u4"))
        found.append((d, codes.astype(np.int64) + (r << 32), held))
    size = {n: (len(np.unique(ngram_join._codes(s, ranges))), len(s)) for n, s in zip(names, sets)}

    def alone_and_prefix(d, count):
        return np.array([size[x][0] for x in d]) - count, ngram_join.prefix_length(np.array([size[x][1] for x in d]), num, den)

    out = defaultdict(set)
    for d, k in zip(*ngram_join._prefix_of(*(np.concatenate(c) for c in zip(*found)), alone_and_prefix)):
        out[d].add(int(k))
    return [out[n] for n in names]


@pytest.mark.parametrize("num, den", [(9, 10), (8, 10), (7, 10)])
def test_linked_sets_share_a_key_at_any_threshold(spark, num, den):
    rng = np.random.RandomState(3)
    sets, pairs = [], []
    common = np.unique(rng.randint(0, 2 ** 62, 300).astype(np.uint64))
    for n in (4, 5, 10, 18, 40, 200, 1500):
        for _ in range(30):
            own = np.unique(rng.randint(0, 2 ** 62, n).astype(np.uint64))
            a = np.unique(np.concatenate([own[n // 3:], rng.choice(common, min(len(common), n // 3), replace=False)]))
            lost = (den - num) * len(a) // (num + den)   # a change takes one n-gram and brings one
            b = np.unique(np.concatenate([rng.choice(a, len(a) - lost, replace=False), rng.randint(0, 2 ** 62, lost).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if lost and den * both >= num * (len(a) + len(b) - both):
                pairs.append((len(sets), len(sets) + 1))
                sets += [a, b]
    assert len(pairs) >= 90
    for ranges in (1, 7):
        keys = prefixes(spark, sets + sets[:50], num, den, ranges)       # copies change nothing
        assert all(keys[i] & keys[j] for i, j in pairs)
        assert keys[:len(sets)] == prefixes(spark, sets, num, den, ranges)
    lone = [np.unique(rng.randint(0, 2 ** 62, 100).astype(np.uint64)) for _ in range(20)]
    assert not any(prefixes(spark, sets + lone, num, den, 7)[len(sets):])


# ---------------------------------------------------------------- mixing fills a quota past long documents
def words_of(df):
    out, listed = mixing.mix(df, F.array("s"), F.col("n"), weights=lambda names: [3 if s == "a" else 1 for s in names], max_repeat=3)
    return out.collect(), listed


@pytest.mark.parametrize("walk", [0, 2000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_passes_over_documents_that_do_not_fit(spark, monkeypatch, seed, walk):
    monkeypatch.setattr(mixing, "WALK_ROWS", walk)
    rng = np.random.RandomState(seed)
    data = [(i, "a", 500) for i in range(300)] + [(1000 + i, "a", 300_000 + i) for i in range(2)] + [(2000 + i, "b", int(x)) for i, x in enumerate(rng.randint(1, 4000, 200))]
    data += [(2100, "b", 77), (2100, "b", 77), (None, "b", 5), (None, "b", 5)]
    got, listed = words_of(spark.createDataFrame(data, "doc_id long, s string, n long").repartition(3))
    assert len(got) == len(data)
    for name, (_, target) in listed.items():
        mine = [r for r in got if r["sources"] == [name]]
        least = min(r["repeats"] for r in mine)
        gap = round(target) - sum(r["taken"] for r in mine)
        assert all(r["repeats"] - least in (0, 1) for r in mine)
        assert gap >= 0 and all(r["size"] > gap for r in mine if r["repeats"] == least)


@pytest.mark.parametrize("walk", [0, 2000])
def test_mix_takes_equal_rows_one_by_one(spark, monkeypatch, walk):
    monkeypatch.setattr(mixing, "WALK_ROWS", walk)
    data = [(None, "a", 6)] * 10 + [(7, "b", 50)] * 4 + [(8, "b", 30)] * 3
    for weights in ([1, 9], [9, 1], [2, 3]):
        df = spark.createDataFrame(data, "doc_id long, s string, n long").repartition(4)
        out, listed = mixing.mix(df, F.array("s"), F.col("n"), weights=lambda names: weights, max_repeat=3)
        got = out.collect()
        assert len(got) == len(data)
        for name, (_, target) in listed.items():
            mine = [r for r in got if r["sources"] == [name]]
            gap, least = round(target) - sum(r["taken"] for r in mine), min(r["repeats"] for r in mine)
            assert 0 <= gap and all(r["size"] > gap for r in mine if r["repeats"] == least) and max(r["repeats"] for r in mine) <= 3


def test_flow_costs_no_more_than_any_other(spark):
    """Against every split of small capacities over the sources."""
    rng = np.random.RandomState(8)

    def dearest(used, capacity):
        return sum((u // c) * c * (u // c - 1) // 2 + (u % c) * (u // c) for u, c in zip(used, capacity))

    for _ in range(25):
        capacity = [int(x) for x in rng.randint(1, 3, 3)]
        members = [sorted(rng.choice(2, rng.randint(1, 3), replace=False).tolist()) for _ in capacity]
        quota = [int(x) for x in rng.randint(0, 6, 2)]
        flow = mixing.min_cost_flow(capacity, members, quota, 3)
        best = {}
        choices = [[dict(zip(m, f)) for f in itertools.product(range(3 * c + 1), repeat=len(m)) if sum(f) <= 3 * c] for c, m in zip(capacity, members)]
        for combo in itertools.product(*choices):
            got = [sum(f.get(s, 0) for f in combo) for s in range(2)]
            if all(g <= q for g, q in zip(got, quota)):
                cost = dearest([sum(f.values()) for f in combo], capacity)
                best[sum(got)] = min(best.get(sum(got), 1 << 30), cost)
        total = sum(sum(f.values()) for f in flow)
        assert total == max(best) and dearest([sum(f.values()) for f in flow], capacity) == best[total]


def test_mix_takes_the_short_documents_behind_a_long_one(spark):
    data = [(i, "a", 500) for i in range(1000)] + [(5000, "a", 1_000_000)]
    for seed in range(4):
        base = spark.createDataFrame(data, "doc_id long, s string, n long")
        order = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "n")
        base = base.select(F.col("doc_id").cast("string").alias("_id"), F.col("n").alias("_size"), F.lit("p").alias("_pattern"), order.alias("_order"),
                           F.shiftrightunsigned(order, 64 - mixing.SLICE_BITS).alias("_slice"))
        rules, hits = mixing._part_pass(base, {"p": 750_000})
        swept = [r["_size"] for r in base.collect() if any(r["_size"] <= g and r["_slice"] < e for g, e in rules["p"])]
        listed = [r["_size"] for r in hits.join(base, "_id").collect()]
        assert sum(swept) + sum(listed) == 500_000


# ---------------------------------------------------------------- passages shared past closer neighbours
def families(n):
    """A and B share 50 words around a gram; documents that share 45 of them lie between in either sort."""
    rng = np.random.RandomState(11)
    fresh = lambda k: [f"n{rng.randint(10 ** 9)}" for _ in range(k)]
    data = []
    for f in range(n):
        gram, left, right = ([f"f{f}{side}{i}" for i in range(k)] for side, k in (("g", 20), ("l", 20), ("r", 20)))
        doc = lambda l, r: fresh(30) + left[20 - l:] + gram + right[:r] + fresh(30)
        data += [doc(15, 15), doc(15, 15), *(doc(5, 20) for _ in range(8)), *(doc(20, 5) for _ in range(8))]
    return [(i, " ".join(w)) for i, w in enumerate(data)]


def brute_passages(data, least=50):
    """Words in windows of another document, and of those the ones whose first copy is elsewhere."""
    first, holders, words = {}, defaultdict(set), {}
    for doc, text in sorted(data):
        words[doc] = brute.WORD.findall(text)
        for i in range(len(words[doc]) - least + 1):
            key = tuple(words[doc][i:i + least])
            first.setdefault(key, doc)
            holders[key].add(doc)
    out = {}
    for doc, w in words.items():
        at = [(i, tuple(w[i:i + least])) for i in range(len(w) - least + 1)]
        shared = [(i, k) for i, k in at if len(holders[k]) > 1]
        out[doc] = ({x for i, _ in shared for x in range(i, i + least)}, {x for i, k in shared if first[k] != doc for x in range(i, i + least)})
    return out


def check_passages(spark, data):
    want, texts = brute_passages(data), dict(data)
    for r in suffix_dedup.repeated_passages(rows(spark, [(d, t, "en", "s") for d, t in data])).collect():
        at = [(i, m.start(), m.end()) for i, m in enumerate(brute.WORD.finditer(texts[r["doc_id"]]))]
        got = tuple({i for i, a, b in at if any(s["start"] <= a and b <= s["end"] for s in r[c])} for c in ("repeats", "removed"))
        assert got == want[r["doc_id"]], r["doc_id"]


def test_passages_are_found_past_closer_neighbours(spark):
    data = families(40)
    assert any(whole for whole, _ in brute_passages(data).values())
    check_passages(spark, data)


def test_second_copies_of_a_passage_inside_longer_matches_go(spark):
    rng = np.random.RandomState(4)
    base = [f"b{i}" for i in range(200)]
    fresh = lambda k: [f"n{rng.randint(10 ** 9)}" for _ in range(k)]
    cuts = [(0, 120), (0, 120), (60, 200), (40, 140), (70, 130), (10, 200), (75, 125)]
    check_passages(spark, [(i, " ".join(fresh(20) + base[a:b] + fresh(20))) for i, (a, b) in enumerate(cuts * 3)])


# ---------------------------------------------------------------- mixed and short texts pass language identification
def test_language_stage_keeps_mixtures_and_short_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    by = {r["lang"]: r["text"] for r in docs.filter("length(text) > 3000 AND lang IS NOT NULL").dropDuplicates(["lang"]).collect()}
    langs = sorted(by)
    assert len(langs) >= 3
    word = by["en"].split()[3]
    planted = {-1: "\n".join(by[k][:1200] for k in langs), -2: " ".join(by[k][i:i + 100] for i in range(0, 1200, 100) for k in langs),
               -3: "ok", -4: "the", -5: f"{word} the and", -6: "\u4e2d\u6587\u6587\u672c\u8bed\u8a00" * 60, -7: "12345 67890", -8: "Hi"}
    extra = spark.createDataFrame([(k, t, None, "s", len(t)) for k, t in planted.items()], "doc_id long, text string, lang string, source string, n_chars long")
    got = P.language_id(spark, docs.select(*extra.columns).unionByName(extra), SF)
    assert {r["doc_id"] for r in got.filter("doc_id < 0").collect()} == {-1, -2, -3, -4, -5, -8}
    # no clean document of the table goes
    assert got.filter("doc_id >= 0").count() == docs.filter("text RLIKE '[a-zA-Z]'").count()


def test_language_of_texts_without_a_letter(spark):
    texts = ["½½½½ ²²²² ⅧⅧ", "①②③ 12", "१२३", "ªº words", "x", "—", None]
    df = rows(spark, [(5 * i + 1, "plain english words are here", "en", "a") for i in range(30)] + [(1000 + i, t, "en", "a") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict_all(df).collect()}
    assert [got[1000 + i] for i in range(len(texts))] == ["und", "und", "und", "en", "en", "und", "und"]
