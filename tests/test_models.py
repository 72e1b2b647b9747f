"""Models: keyed least squares vs Spark ML, recursive forecast vs a Python loop, selection."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.documents import read_document
from tickwise.operators import forecast as FC
from tickwise.operators import models as ML
from tickwise.operators import regression as RG
from tickwise.operators import series as S
from tickwise.schemas import FEATURE_COLS


@pytest.fixture(scope="module")
def feats(spark):
    rng = random.Random(3)
    rows, seq = [], 0
    for key, n, drift in (("A", 220, 0.002), ("B", 160, -0.001)):
        p, t = 100.0, 1_704_067_200.0
        for _ in range(n):
            p = round(p * (1 + drift + rng.gauss(0, 0.01)), 2)
            t += rng.choice([55, 60, 65])
            seq += 1
            rows.append((key, p, t, seq))
    base = spark.createDataFrame(rows, "symbol string, price double, ts double, seq long")
    f = S.with_positions(S.series_features(base, width=3000.0), key_extra=S.key_sizes(base))
    return S.chrono_split(f).cache()


def test_keyed_ols_matches_spark_ml_linear_regression(spark, feats):
    train = feats.where("split = 'train'")
    coefs = RG.fit_keyed_ols(train, "symbol", FEATURE_COLS, "pct_change")
    ours = {(r.symbol, r.seq): r.prediction for r in
            RG.predict_keyed(feats, coefs, "symbol", FEATURE_COLS).collect()}
    for key in ("A", "B"):
        model = ML.make_pipeline("LinearRegression").fit(train.where(F.col("symbol") == key))
        for r in model.transform(feats.where(F.col("symbol") == key)).collect():
            assert ours[(key, r.seq)] == pytest.approx(r.prediction, rel=1e-6, abs=1e-8)


def test_recursive_forecast_matches_python_loop(spark, feats):
    coefs = RG.fit_keyed_ols(feats, "symbol", FEATURE_COLS, "pct_change")
    ctx = FC.context(feats)
    got = {(r.symbol, r.step): r for r in FC.forecast_linear(ctx, coefs).collect()}
    cmap = {r.symbol: [r.intercept] + [r[f"b{i}"] for i in range(7)] for r in coefs.collect()}
    for c in ctx.collect():
        b = cmap[c.symbol]
        model = lambda x, b=b: b[0] + sum(w * v for w, v in zip(b[1:], x))
        prices, pcts = list(c.prices), list(c.pcts)
        for step in range(1, 11):  # each step from a one-row frame of the state so far
            state = spark.createDataFrame([(prices, pcts)], "prices array<double>, pcts array<double>")
            x = state.select(*[f.alias(n) for n, f in FC.step_features(F.col("prices"), F.col("pcts")).items()]).first()
            pct = model([x[n] for n in FEATURE_COLS])
            price = round(prices[-1] * (1 + pct / 100), 2)
            prices.append(price)
            pcts.append(pct)
            g = got[(c.symbol, step)]
            assert g.ts == c.last_ts + c.interval_s * step
            assert g.price == pytest.approx(price, abs=0.011) and g.pct == pytest.approx(pct, rel=1e-9)


def test_model_path_forecast_equals_expression_path(spark, feats):
    key = "A"
    part = feats.where(F.col("symbol") == key)
    model = ML.make_pipeline("LinearRegression").fit(part)
    ctx = FC.context(part)
    a = {r.step: r.price for r in FC.forecast_with_model(ctx, ML.model_predictor(model)).collect()}
    coefs = RG.fit_keyed_ols(part, "symbol", FEATURE_COLS, "pct_change")
    b = {r.step: r.price for r in FC.forecast_linear(ctx, coefs).collect()}
    assert a.keys() == b.keys() == set(range(1, 11))
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=0.011)


def test_select_best_rules(spark):
    m = spark.createDataFrame([
        ("A", "LinearRegression", 0, 0.5, 1.0), ("A", "RandomForest", 1, 0.5, 0.5), ("A", "GBT", 2, 0.4, 0.1),
        ("B", "LinearRegression", 0, float("nan"), 1.0), ("B", "RandomForest", 1, -3.0, 2.0),
        ("C", "LinearRegression", 0, -999.0, 1.0),
    ], "symbol string, name string, order int, r2 double, mae double")
    best = {r.symbol: r.name for r in FC.select_best(m).collect()}
    assert best == {"A": "LinearRegression", "B": "RandomForest"}


def test_forecast_job_outputs_and_small_run_keeps_previous(spark, tmp_path):
    import json
    from tickwise.plans.forecast_job import build_forecast, write_forecast_outputs
    rows = [("BTC", 100.0 + (i % 7) * 0.5 + i * 0.1, float(1_704_067_200 + 60 * i), i) for i in range(60)]
    prices = spark.createDataFrame(rows, "symbol string, price_usd double, ts double, seq long") \
        .withColumn("event_ts", F.timestamp_seconds("ts"))
    out = str(tmp_path / "out")
    assert write_forecast_outputs(spark, build_forecast(spark, prices, models=["LinearRegression"]), out)
    doc = read_document(f"{out}/forecast")
    assert len(doc["BTC"]["history"]) == 50 and len(doc["BTC"]["forecast"]) == 10
    tiny = build_forecast(spark, prices.limit(19), models=["LinearRegression"])   # P5: < 20 rows
    assert tiny.count() == 0 and not write_forecast_outputs(spark, tiny, out)
    assert read_document(f"{out}/forecast") == doc    # R17: old file kept


def test_one_feature_closed_form_equals_general_solve(spark):
    rows = [("A", float(i), 2.0 + 0.5 * i + (i % 3) * 0.1) for i in range(40)]
    rows += [("C", 7.0, float(i)) for i in range(10)]          # constant feature: slope 0
    df = spark.createDataFrame(rows, "k string, x double, y double")
    closed = {r.k: (r.intercept, r.b0) for r in RG.fit_keyed_ols(df, "k", ["x"], "y").collect()}
    general = {r.k: (r.intercept, r.b0) for r in RG.solve_ols(RG.ols_stats(df, ["k"], ["x"], "y"), ["k"], 1).collect()}
    for k in ("A", "C"):
        assert closed[k] == pytest.approx(general[k], rel=1e-9, abs=1e-9)
    assert closed["C"] == pytest.approx((4.5, 0.0))


@pytest.mark.parametrize("noise", [1e-2, 1e-5, 1e-7])
def test_least_squares_keeps_its_digits_around_a_large_mean(spark, noise):
    rng = random.Random(5)
    rows = []
    for _ in range(4000):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append(("A", 1 + noise * a, 1 + noise * b, 0.25 * a - 0.5 * b + rng.gauss(0, 0.1)))
    df = spark.createDataFrame(rows, "k string, x double, z double, y double").repartition(4)
    got = RG.fit_keyed_ols(df, "k", ["x", "z"], "y").first()
    x = np.array([[r[1] - 1, r[2] - 1] for r in rows])
    y = np.array([r[3] for r in rows])
    want, *_ = np.linalg.lstsq(np.column_stack([(x - x.mean(0)) / noise]), y - y.mean(), rcond=None)
    assert [got.b0 * noise, got.b1 * noise] == pytest.approx(list(want), rel=1e-6)
    pred = RG.regression_metrics(df.withColumn("prediction", F.lit(1.0)), ["k"], "x").first()
    assert math.isfinite(pred.r2)


def test_broadcast_bound_counts_bytes(spark):
    from tickwise.operators.lookup import fits_broadcast
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert fits_broadcast(df, 20_000) and not fits_broadcast(df, 5_000) and fits_broadcast(df.limit(0), 1_000)
