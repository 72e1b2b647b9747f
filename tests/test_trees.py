"""Keyed trees: against Spark ML, plain growth, and between the two ways of growing."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwise.operators import forecast as FC
from tickwise.operators import models as ML
from tickwise.operators import regression as RG
from tickwise.operators import trees as TR

FEATURES = ["a", "b", "c", "d", "e", "f", "g"]


def table(spark, keys, rows, seed=1, noise=0.3):
    rng = np.random.RandomState(seed)
    out = []
    for k in range(keys):
        x = np.round(rng.standard_normal((rows, 7)), 4)
        y = 2 * x[:, 0] + np.where(x[:, 1] > 0.3, 3.0, -1.0) * (k + 1) + np.sin(3 * x[:, 2]) + noise * rng.standard_normal(rows)
        out += [(f"k{k}", i + 1, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(out, "symbol string, pos long, " + ", ".join(f"{f} double" for f in FEATURES) + ", y double").repartition(5)


def models(df, spec, **kw):
    return {r["symbol"]: (bytes(r["feature"]), bytes(r["cut"]), bytes(r["value"])) for r in TR.fit(df, "symbol", FEATURES, "y", spec, **kw).collect()}


@pytest.mark.parametrize("name", ["RandomForest", "GBT"])
def test_fit_is_as_good_as_spark_ml(spark, name):
    from pyspark.ml.feature import VectorAssembler
    df = table(spark, 1, 1500).cache()
    train, val = df.where("pos <= 1200"), df.where("pos > 1200")
    spec = TR.KINDS[name]
    ours = RG.regression_metrics(TR.predict(val, TR.fit(train, "symbol", FEATURES, "y", spec), "symbol", FEATURES, "y", spec), ["symbol"], "y").first()["r2"]
    put = VectorAssembler(inputCols=FEATURES, outputCol="features")
    theirs = ML.make_estimator(name, "y").fit(put.transform(train.coalesce(1)))
    want = RG.regression_metrics(theirs.transform(put.transform(val)), ["symbol"], "y").first()["r2"]
    assert ours > 0.5 and ours >= want - 0.01


@pytest.mark.parametrize("spec", [TR.Trees(6, 3, 3, False), TR.Trees(4, 3, 0, True)])
def test_shards_and_layout_do_not_change_a_tree(spark, spec):
    df = table(spark, 3, 400, seed=2).cache()
    alone = models(df, spec)
    assert models(df.repartition(2), spec) == alone
    assert models(df, spec, shard_rows=90) == alone       # every key over several shards
    mixed = df.unionByName(table(spark, 1, 50, seed=3).withColumn("symbol", F.lit("small")))
    got = models(mixed, spec, shard_rows=150)
    assert {k: got[k] for k in alone} == alone and "small" in got


@pytest.mark.parametrize("spec", [TR.Trees(4, 3, 3, False), TR.Trees(4, 3, 0, True)])
def test_rows_are_dealt_once_for_all_levels(spark, spec, monkeypatch):
    calls, dealt = [], TR._dealt
    monkeypatch.setattr(TR, "_dealt", lambda *a, **kw: calls.append(1) or dealt(*a, **kw))
    monkeypatch.setattr(TR, "KEPT_SPLITS", 20, raising=False)
    df = table(spark, 2, 200, seed=8).cache()
    many = models(df, spec, shard_rows=60)
    assert len(calls) == 2      # keys of one shard, and keys of several: not per level or tree
    assert many == models(df, spec)


def test_first_split_is_the_best_of_all(spark):
    df = table(spark, 1, 60, seed=4)
    rows = sorted(df.collect(), key=lambda r: r["pos"])
    x, y = np.array([[r[f] for f in FEATURES] for r in rows]), np.array([r["y"] for r in rows])
    head = TR.key_info(df, "symbol", FEATURES, "y").first()
    cuts = np.array(head["cuts"]).reshape(7, -1)
    spec = TR.Trees(1, 1, 0, True)
    grown = TR.grow(TR.codes_of(x, cuts), np.arange(60), y, head["scale"], spec)

    def sse(v):
        return ((v - v.mean()) ** 2).sum() if len(v) else 0.0

    best = min((sse(y[x[:, f] <= c]) + sse(y[x[:, f] > c]), f, b) for f in range(7) for b, c in enumerate(cuts[f]) if 0 < (x[:, f] <= c).sum() < 60)
    assert (grown.feature[0, 0], grown.cut[0, 0]) == best[1:]
    got = TR.predicted(TR.codes_of(x, cuts), grown.feature, grown.cut, grown.values(head["scale"]), 1)
    left = x[:, best[1]] <= cuts[best[1]][best[2]]
    assert got == pytest.approx(np.where(left, y[left].mean(), y[~left].mean()), abs=1e-6)


def test_weights_and_subsets():
    w = np.concatenate([TR.row_weights(t, np.arange(2000)) for t in range(10)])
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.04
    picks = [TR.allowed(TR.FOREST, t, n, 7) for t in range(20) for n in range(20)]
    assert all(p.sum() == 3 for p in picks) and min(np.sum(picks, axis=0)) > 100
    assert TR.allowed(TR.BOOSTED, 0, 0, 7).all()


def test_constant_tiny_and_empty_input(spark):
    flat = spark.createDataFrame([("c", i, *[1.0] * 7, 5.0) for i in range(30)] + [("one", 1, *[0.5] * 7, -2.0)],
                                 "symbol string, pos long, " + ", ".join(f"{f} double" for f in FEATURES) + ", y double")
    for spec in (TR.Trees(5, 3, 3, False), TR.Trees(5, 3, 0, True)):
        got = {(r["symbol"], r["prediction"]) for r in TR.predict(flat.where("symbol = 'c'"), TR.fit(flat, "symbol", FEATURES, "y", spec), "symbol", FEATURES, "y", spec).collect()}
        assert len(got) == 1 and next(iter(got))[1] == pytest.approx(5.0, abs=1e-6)
        assert TR.fit(flat.limit(0), "symbol", FEATURES, "y", spec).count() == 0
        assert {r["symbol"] for r in TR.fit(flat, "symbol", FEATURES, "y", spec).collect()} == {"c", "one"}
    metrics = ML.tree_metrics(flat.withColumnsRenamed(dict(zip(FEATURES, ML.FEATURE_COLS))).withColumnRenamed("y", ML.LABEL).where("symbol = 'c'"),
                              flat.withColumnsRenamed(dict(zip(FEATURES, ML.FEATURE_COLS))).withColumnRenamed("y", ML.LABEL), "RandomForest")
    assert [(r["symbol"], r["name"]) for r in ML.missing_models(metrics, flat, ["RandomForest"]).collect()] != []


def test_many_keys_in_a_fixed_number_of_jobs(spark):
    sc = spark.sparkContext
    jobs = []
    for keys in (3, 120):
        df = table(spark, keys, 30, seed=5)
        sc.setJobGroup(f"trees-{keys}", "count jobs")
        got = TR.fit(df, "symbol", FEATURES, "y", TR.Trees(3, 2, 3, False)).collect()
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"trees-{keys}")))
        assert len(got) == keys
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_forecast_of_carried_models(spark):
    from tickwise.plans.forecast_job import build_forecast
    rng = np.random.RandomState(6)
    rows = [(k, float(100 + 5 * math.sin(i / 3) + rng.rand()), float(1_704_067_200 + 60 * i), i) for k in ("A", "B") for i in range(90)]
    prices = spark.createDataFrame(rows, "symbol string, price_usd double, ts double, seq long").withColumn("event_ts", F.timestamp_seconds("ts"))
    for name in ("RandomForest", "GBT"):
        got = build_forecast(spark, prices, models=[name]).collect()
        assert {r["symbol"] for r in got} == {"A", "B"}
        for r in got:
            assert r["model"]["name"] == name and len(r["forecast"]) == 10 and len(r["history"]) == 50
            assert all(math.isfinite(p["price"]) for p in r["forecast"])
    every = {r["symbol"]: r["model"]["name"] for r in build_forecast(spark, prices).collect()}
    assert set(every) == {"A", "B"} and set(every.values()) <= set(ML.MODEL_ORDER)


@pytest.mark.parametrize("consistent", [False, True])
def test_next_features_equal_the_column_expressions(spark, consistent):
    rng = np.random.RandomState(7)
    cases = [((100 + rng.rand(n)).tolist(), rng.standard_normal(n).tolist()) for n in (1, 2, 3, 4, 5, 6, 7, 14, 15, 20)] + [([0.0] * 9, [1.0] * 9)]
    df = spark.createDataFrame(cases, "prices array<double>, pcts array<double>")
    got = df.select("prices", "pcts", *[c.alias(n) for n, c in FC.step_features(F.col("prices"), F.col("pcts"), consistent).items()]).collect()
    for r in got:
        want = TR.next_features(list(r["prices"]), list(r["pcts"]), consistent)
        for n, v in want.items():
            assert (r[n] is None and math.isnan(v)) or r[n] == pytest.approx(v, rel=1e-9, abs=1e-12), n


def test_a_diverging_forecast_ends_without_an_error(spark):
    big = TR.next_features([1e300, -1e300] * 5, [1e300, -1e300] * 5, False)
    assert math.isinf(big["volatility"]) or math.isnan(big["volatility"])
    rows = spark.createDataFrame([("k", i, *[float(i)] * 7, 1e9 * (1 if i % 2 else 3)) for i in range(40)], "symbol string, pos long, " + ", ".join(f"{f} double" for f in ML.FEATURE_COLS) + ", y double")
    spec = TR.Trees(3, 2, 0, True)
    ctx = spark.createDataFrame([("k", [1e200, 2e200], [1.0, 2.0], 0.0, 60)], "symbol string, prices array<double>, pcts array<double>, last_ts double, interval_s long")
    got = TR.forecast(ctx, TR.fit(rows, "symbol", ML.FEATURE_COLS, "y", spec), "symbol", ML.FEATURE_COLS, spec, 30).collect()
    assert [r["step"] for r in got] == list(range(1, 31)) and not all(math.isfinite(r["price"]) for r in got)
