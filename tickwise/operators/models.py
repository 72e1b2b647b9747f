"""Model set and validation metrics.

All models run keyed, for every key at once: linear regression by sufficient statistics
(``regression.py``), tree models by merged histograms (``trees.py``). The Spark ML pipelines of the
same models (one series at a time) are kept for single series and as the yardstick of the tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.operators import trees as TR
from tickwise.operators.regression import regression_metrics
from tickwise.schemas import FEATURE_COLS

LABEL = "pct_change"

# Candidate models in selection order (ties keep the earlier one) and their settings.
from tickwise.constants import (GBT_DEPTH, GBT_ITER, LR_MAX_ITER, MAE_DIGITS,  # noqa: E402
                                MODEL_ORDER, R2_DIGITS, RF_DEPTH, RF_TREES, SEED)

def make_estimator(name: str, label: str = LABEL):
    """M3 linear regression, M4 random forest, M5 gradient-boosted trees."""
    if name == "LinearRegression":
        return LinearRegression(featuresCol="features", labelCol=label, maxIter=LR_MAX_ITER)
    if name == "RandomForest":
        return RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=RF_TREES,
                                     maxDepth=RF_DEPTH, seed=SEED)
    if name == "GBT":
        return GBTRegressor(featuresCol="features", labelCol=label, maxIter=GBT_ITER, maxDepth=GBT_DEPTH, seed=SEED)
    raise ValueError(name)


def make_pipeline(name: str, label: str = LABEL, features: Sequence[str] = FEATURE_COLS) -> Pipeline:
    """M1 + M2 + M6: assembler -> standard scaler (mean and std) -> model."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        make_estimator(name, label),
    ])


def round_metrics(m: DataFrame) -> DataFrame:
    """A7 reporting precision: R^2 to 4 digits, MAE to 6 (R16: MAE is in percentage points)."""
    return m.withColumn("r2", F.round("r2", R2_DIGITS)).withColumn("mae", F.round("mae", MAE_DIGITS))


def tree_metrics(train: DataFrame, val: DataFrame, name: str, key: str = "symbol", label: str = LABEL,
                 features: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """M4 / M5 + A7: validation metrics (key, name, order, r2, mae) of trees fitted on ``train``, all keys at once."""
    spec = TR.KINDS[name]
    pred = TR.predict(val, TR.fit(train, key, features, label, spec), key, features, label, spec)
    return regression_metrics(pred, [key], label).select(
        key, F.lit(name).alias("name"), F.lit(MODEL_ORDER.index(name)).alias("order"), "r2", "mae")


def missing_models(metrics: DataFrame, keys: DataFrame, names: Sequence[str], key: str = "symbol") -> DataFrame:
    """M7: (key, name) without a usable validation result -- no model, or an R^2 that is not a number."""
    usable = metrics.where(F.col("r2").isNotNull() & ~F.isnan("r2")).select(key, "name")
    every = keys.select(key).distinct().select(key, F.explode(F.array(*[F.lit(n) for n in names])).alias("name"))
    return every.join(usable, [key, "name"], "left_anti")


def model_predictor(model: PipelineModel):
    """Adapter for ``forecast_with_model``: adds ``prediction`` and drops model scratch columns."""
    def predict(df: DataFrame) -> DataFrame:
        return model.transform(df).drop("raw_features", "features")
    return predict
