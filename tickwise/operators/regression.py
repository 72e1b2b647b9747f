"""Keyed ordinary least squares from sufficient statistics (M3 at scale, A7).

For regParam 0 the original's linear model (assembler -> standard scaler -> linear
regression) is the ordinary least-squares fit with intercept; scaling does not change its
predictions. Per key it needs the means, variances and covariances, which Spark aggregates partially
and merges without cancellation -- a key holding a third of the rows costs one small buffer per
task, and features that barely move around a large mean keep their digits. The p x p solve runs per key on the one-row-per-key summary in a
``mapInPandas`` helper (numpy, no data through the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.operators.lookup import join_small


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def ols_stats(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str) -> DataFrame:
    """Per-group moments about the means needed for the least-squares fit."""
    x = [F.col(c) for c in features]
    y = F.col(label)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("st_n"),
        F.array(*[F.avg(c) for c in x]).alias("st_mx"),
        F.avg(y).alias("st_my"),
        F.array(*[F.covar_pop(x[i], x[j]) for i, j in _pairs(len(x))]).alias("st_cxx"),
        F.array(*[F.covar_pop(c, y) for c in x]).alias("st_cxy"))


def _solve_row(n, mx, my, cov, cxy, p):
    if n is None or n < 1:
        return [float("nan")] * (p + 1)
    mx, cxy = np.asarray(mx, float), np.asarray(cxy, float)
    cxx = np.zeros((p, p))
    for v, (i, j) in zip(cov, _pairs(p)):
        cxx[i, j] = cxx[j, i] = v
    d = np.sqrt(np.clip(np.diag(cxx), 0.0, None))
    live = d > 1e-12 * np.maximum(1.0, np.abs(mx))
    b = np.zeros(p)
    if live.any():
        ds = d[live]
        a = cxx[np.ix_(live, live)] / np.outer(ds, ds)
        rhs = cxy[live] / ds
        bs, *_ = np.linalg.lstsq(a, rhs, rcond=None)
        b[live] = bs / ds
    return [float(my - mx @ b), *map(float, b)]


def solve_ols(stats: DataFrame, keys: Sequence[str], p: int) -> DataFrame:
    """One row per group: ``intercept`` and ``b0..b{p-1}`` (constant features get 0)."""
    keys = list(keys)
    key_fields = ", ".join(f"`{k}` {t}" for k, t in
                           ((f.name, f.dataType.simpleString()) for f in stats.schema.fields if f.name in keys))
    schema = key_fields + ", intercept double, " + ", ".join(f"b{i} double" for i in range(p))

    def solve(batches):
        for pdf in batches:
            rows = [_solve_row(r.st_n, r.st_mx, r.st_my, r.st_cxx, r.st_cxy, p) for r in pdf.itertuples(index=False)]
            out = pd.DataFrame(rows, columns=["intercept", *[f"b{i}" for i in range(p)]])
            for k in reversed(keys):
                out.insert(0, k, pdf[k].values)
            yield out

    return stats.mapInPandas(solve, schema)


def linear_prediction(features: Sequence[str], prefix: str = "b") -> Column:
    """intercept + sum b_i * x_i over the coefficient columns joined to the rows."""
    e = F.col("intercept")
    for i, c in enumerate(features):
        e = e + F.col(f"{prefix}{i}") * F.col(c)
    return e


def _solve_one(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One feature: slope = cov(x, y) / var(x), intercept = mean(y) - slope * mean(x); a
    constant feature gets slope 0 (the minimum-norm solution). Pure column expressions."""
    mx, my = F.element_at("st_mx", 1), F.col("st_my")
    vxx, cxy = F.element_at("st_cxx", 1), F.element_at("st_cxy", 1)
    live = vxx > F.lit(1e-24) * F.greatest(F.lit(1.0), mx * mx)
    slope = F.when(live, cxy / vxx).otherwise(F.lit(0.0))
    return stats.select(*keys, (my - slope * mx).alias("intercept"), slope.alias("b0"))


def fit_keyed_ols(df: DataFrame, key: str, features: Sequence[str], label: str,
                  by: Sequence[str] = ()) -> DataFrame:
    """Least squares per group; closed form for one feature, a small solve otherwise."""
    stats = ols_stats(df, [key, *by], features, label)
    if len(features) == 1:
        return _solve_one(stats, [key, *by])
    return solve_ols(stats, [key, *by], len(features))


def predict_keyed(df: DataFrame, coefs: DataFrame, key: str, features: Sequence[str],
                  out: str = "prediction") -> DataFrame:
    c = coefs.withColumnRenamed(key, "_ck")
    j = join_small(df, c, F.col(key) == F.col("_ck"))
    return j.withColumn(out, linear_prediction(features)).drop("_ck", "intercept",
                                                               *[f"b{i}" for i in range(len(features))])


def regression_metrics(pred: DataFrame, keys: Sequence[str], label: str, prediction: str = "prediction") -> DataFrame:
    """R^2 = 1 - SSE/SST (SST around the evaluated rows' mean) and MAE, per group."""
    y, p = F.col(label), F.col(prediction)
    g = pred.groupBy(*keys).agg(
        F.avg((y - p) * (y - p)).alias("m_mse"), F.var_pop(y).alias("m_var"), F.avg(F.abs(y - p)).alias("mae"))
    r2 = F.lit(1.0) - F.try_divide(F.col("m_mse"), F.col("m_var"))
    return g.select(*keys, F.coalesce(r2, F.lit(float("nan"))).alias("r2"), "mae")
