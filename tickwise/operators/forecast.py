"""Recursive multi-step forecast on one row per key.

State per key: arrays ``prices`` and ``pcts`` (the last 15 feature rows, oldest first), the
last time stamp and the sampling interval. A step derives the 7 model features from the
arrays, predicts the next percent change, turns it into a price rounded to cents (R21: the
rounded price but the unrounded percent feed the next step), and appends both.

For linear models the whole horizon is one ``aggregate(sequence(1, H), ...)`` expression;
for Spark ML models the steps are chained ``transform`` calls on the one-row-per-key frame.
Either way it is one lazy plan per run, not a driver loop per key and step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.arrays import arr_mean, arr_pop_std, last, nth_from_end, tail
from tickwise.functions.scalar import iso_utc, safe_ratio
from tickwise.operators.series import CONTEXT_POINTS, HISTORY_POINTS, Series, sampling_interval, tail_rows
from tickwise.schemas import FEATURE_COLS

from tickwise.constants import HORIZON, NO_MODEL_R2  # noqa: E402


def context(feats: DataFrame, s: Series = Series(), k: int = CONTEXT_POINTS) -> DataFrame:
    """W11 + A9: per key the last k feature rows as ordered arrays, last ts and interval.
    ``feats`` carries ``pos``/``n``; only the tail rows are grouped."""
    t = tail_rows(feats, k)
    arr = (t.groupBy(s.key)
           .agg(F.array_sort(F.collect_list(F.struct("pos", s.value, "pct_change"))).alias("_ctx")))
    ctx = arr.select(s.key, F.col(f"_ctx.{s.value}").alias("prices"), F.col("_ctx.pct_change").alias("pcts"))
    iv = sampling_interval(feats, s).withColumnRenamed(s.key, "_ik")
    return ctx.join(iv, ctx[s.key] == iv["_ik"]).drop("_ik")


def history(feats: DataFrame, s: Series = Series(), k: int = HISTORY_POINTS) -> DataFrame:
    """Last k points per key as array<struct<timestamp, price>> in time order."""
    t = tail_rows(feats, k).select(s.key, "pos", iso_utc(s.ts).alias("timestamp"),
                                   F.round(s.value, 2).alias("price"))
    g = t.groupBy(s.key).agg(F.array_sort(F.collect_list(F.struct("pos", "timestamp", "price"))).alias("_h"))
    return g.select(s.key, F.transform("_h", lambda e: F.struct(e["timestamp"].alias("timestamp"),
                                                                e["price"].alias("price"))).alias("history"))


def step_features(prices: Column, pcts: Column, consistent: bool = False) -> dict[str, Column]:
    """The 7 features of the next step from the context arrays.

    Parity (default) keeps the original's forecast-time definitions: momentum against the
    element 5th from the end (R4) and population deviation of the last 7 changes (R5);
    ``consistent=True`` uses the training definitions (6th from the end, sample deviation)."""
    lag1 = last(pcts)
    lag2 = nth_from_end(pcts, 2, lag1)
    lag3 = nth_from_end(pcts, 3, lag2)
    ma7 = arr_mean(tail(prices, 7))
    ma14 = arr_mean(tail(prices, 14))
    p7 = tail(pcts, 7)
    if consistent:
        m = arr_mean(p7)
        ss = F.aggregate(p7, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m))
        vol = F.sqrt(F.try_divide(ss, F.size(p7) - F.lit(1)))
        base = nth_from_end(prices, 6)
    else:
        vol = arr_pop_std(p7)
        base = nth_from_end(prices, 5)
    momentum = F.coalesce(F.try_divide(last(prices) - base, base) * F.lit(100.0), F.lit(0.0))
    return {
        "pct_lag1": lag1, "pct_lag2": lag2, "pct_lag3": lag3,
        "ma_ratio": safe_ratio(last(prices), ma7, 1.0),
        "ma_cross": safe_ratio(ma7, ma14, 1.0),
        "volatility": vol, "momentum": momentum,
    }


def next_price(prev: Column, pct: Column) -> Column:
    """Prev * (1 + pct/100), rounded to cents (F2; Spark's half-up rounding, R6)."""
    return F.round(prev * (F.lit(1.0) + pct / F.lit(100.0)), 2)


def forecast_linear(ctx: DataFrame, coefs: DataFrame, key: str = "symbol",
                    features: Sequence[str] = FEATURE_COLS, horizon: int = HORIZON,
                    consistent: bool = False) -> DataFrame:
    """M9 for a linear model: the whole horizon as one higher-order expression per key.
    ``coefs``: key, intercept, b0..b{p-1}. Output: key, step, ts, timestamp, price, pct."""
    c = coefs.withColumnRenamed(key, "_ck")
    j = ctx.join(c, ctx[key] == c["_ck"]).drop("_ck")
    bcols = [F.col(f"b{i}") for i in range(len(features))]

    def merge(acc, i):
        f = step_features(acc["prices"], acc["pcts"], consistent)
        pred = F.col("intercept")
        for b, name in zip(bcols, features):
            pred = pred + b * f[name]
        price = next_price(last(acc["prices"]), pred)
        ts = F.col("last_ts") + F.col("interval_s").cast("double") * i.cast("double")
        return F.struct(F.concat(acc["prices"], F.array(price)).alias("prices"),
                        F.concat(acc["pcts"], F.array(pred)).alias("pcts"),
                        F.concat(acc["out"], F.array(F.struct(i.cast("long").alias("step"), ts.alias("ts"),
                                                              price.alias("price"), pred.alias("pct")))).alias("out"))

    out_t = "array<struct<step:bigint,ts:double,price:double,pct:double>>"
    init = F.struct(F.col("prices").alias("prices"), F.col("pcts").alias("pcts"),
                    F.array().cast(out_t).alias("out"))
    run = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, merge)
    res = j.select(key, F.explode(run["out"]).alias("o"))
    return res.select(key, "o.step", "o.ts", iso_utc(F.col("o.ts")).alias("timestamp"), "o.price", "o.pct")


def forecast_with_model(ctx: DataFrame, predict: Callable[[DataFrame], DataFrame], key: str = "symbol",
                        horizon: int = HORIZON, consistent: bool = False) -> DataFrame:
    """M9 for any model given as ``predict(df) -> df + 'prediction'`` over the 7 feature
    columns (e.g. a fitted Spark ML PipelineModel's ``transform``). The steps are chained
    lazily on the one-row-per-key frame."""
    state = ctx.select(key, "prices", "pcts", "last_ts", "interval_s",
                       F.array().cast("array<struct<step:bigint,ts:double,price:double,pct:double>>").alias("out"))
    for i in range(1, horizon + 1):
        f = step_features(F.col("prices"), F.col("pcts"), consistent)
        scored = predict(state.withColumns(f))
        price = next_price(last(F.col("prices")), F.col("prediction"))
        ts = F.col("last_ts") + F.col("interval_s").cast("double") * F.lit(float(i))
        state = scored.select(
            key, F.concat("prices", F.array(price)).alias("prices"),
            F.concat("pcts", F.array(F.col("prediction"))).alias("pcts"), "last_ts", "interval_s",
            F.concat("out", F.array(F.struct(F.lit(i).cast("long").alias("step"), ts.alias("ts"),
                                             price.alias("price"), F.col("prediction").alias("pct")))).alias("out"))
    res = state.select(key, F.explode("out").alias("o"))
    return res.select(key, "o.step", "o.ts", iso_utc(F.col("o.ts")).alias("timestamp"), "o.price", "o.pct")


def select_best(metrics: DataFrame, key: str = "symbol") -> DataFrame:
    """A8 + M7: per key the model with the highest rounded R^2; ties keep the earlier model
    (``order``); NaN never wins (R18). Input: key, name, order, r2, mae."""
    ok = metrics.where(~F.isnan("r2") & F.col("r2").isNotNull() & (F.col("r2") > F.lit(NO_MODEL_R2)))
    best = ok.groupBy(key).agg(F.max_by(F.struct("name", "r2", "mae"),
                                        F.struct(F.col("r2"), -F.col("order"))).alias("_b"))
    return best.select(key, "_b.name", "_b.r2", "_b.mae")
