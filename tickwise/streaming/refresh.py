"""Results refreshed batch by batch.

Each micro-batch is summarised and merged into the stored states of the three aggregates
(``operators/running.py``); rows landed earlier are not read again. States are versions ``v=<batch_id>``
(``streaming/snapshots.py``): a replayed batch starts from the version below its own id and writes the same
one again. Forecasts move with the 80/20 split of a key's whole series, so they are made anew, but for
the keys of the batch only; other keys keep theirs.

All functions made here take (batch, batch_id), for ``foreachBatch`` or as a topic's function of
``ingest.start_pipeline``. An empty batch changes nothing (P11).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.operators import models as ML
from tickwise.operators import series as S
from tickwise.operators.lookup import join_small
from tickwise.operators.running import RESULTS
from tickwise.plans.analysis_job import normalize_news, normalize_prices, write_results
from tickwise.plans.forecast_job import build_forecast, write_forecast_outputs
from tickwise.schemas import NEWS_EVENT, PRICE_EVENT
from tickwise.sources.landing import read_landing
from tickwise.streaming.snapshots import KEEP_VERSIONS, latest_version_below, prune_versions, version_path

_TYPED = {"api": (normalize_prices, PRICE_EVENT), "rss": (normalize_news, NEWS_EVENT)}
_ALL = 1 << 62


def in_turn(*functions: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Several functions of one topic, one after another."""
    def run(batch: DataFrame, batch_id: int) -> None:
        for function in functions:
            function(batch, batch_id)
    return run


def _typed_rows(batch: DataFrame, topic: str) -> DataFrame:
    normalize, schema = _TYPED[topic]
    # the order of arrival plays no part in the aggregates
    return normalize(batch.select(*schema.fieldNames(), F.lit(0).alias("_pos")))


def results_refresher(root: str, topic: str, out_root: str | None = None, keep: int | None = KEEP_VERSIONS):
    """Merges each batch of ``topic`` (``api`` or ``rss``) into the states below ``root``; with ``out_root``
    the result tables and the combined document are written anew from all states (S9, S10)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark, rows = batch.sparkSession, _typed_rows(batch, topic)
        for name, result in RESULTS[topic].items():
            path = f"{root}/{name}"
            before = latest_version_below(spark, path, batch_id)
            states = result.merged(spark.read.parquet(before), rows) if before else result.of(rows)
            states.write.mode("overwrite").parquet(version_path(path, batch_id))
            prune_versions(spark, path, keep)
        if out_root:
            write_results(spark, refreshed_results(spark, root), out_root)
    return run


def refreshed_results(spark: SparkSession, root: str, digits: int | None = None) -> dict[str, DataFrame]:
    """A1-A3 over all rows merged so far, from the newest states; empty where no batch came yet.
    ``digits`` replaces the results' own 2 and 4, at which the order of summation decides exact ties."""
    out = {}
    for topic, results in RESULTS.items():
        _, schema = _TYPED[topic]
        for name, result in results.items():
            newest = latest_version_below(spark, f"{root}/{name}", _ALL)
            states = spark.read.parquet(newest) if newest else result.of(_typed_rows(spark.createDataFrame([], schema), topic))
            out[name] = result.show(states, digits)
    return out


def forecast_refresher(landing: str, root: str, out_root: str | None = None, models: Sequence[str] = tuple(ML.MODEL_ORDER),
                       keep: int | None = KEEP_VERSIONS):
    """Forecasts of the keys of each batch from the landing table ``landing``, as landed up to that batch;
    forecasts of other keys are taken over. Fewer landed rows than the job's minimum change nothing (P5)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        landed = read_landing(spark, landing, PRICE_EVENT, "parquet").where(F.col("batch") <= batch_id)
        prices = normalize_prices(landed)
        if not S.has_rows(S.base_series(prices), S.MIN_ROWS_TOTAL):
            return
        keys = batch.where(F.col("symbol").isNotNull()).select(F.col("symbol").alias("_k")).distinct()
        result = build_forecast(spark, join_small(prices, keys, F.col("symbol") == F.col("_k"), "left_semi"), models=models, min_rows=1)
        before = latest_version_below(spark, root, batch_id)
        if before:
            stored = spark.read.parquet(before)
            result = result.unionByName(join_small(stored, keys, F.col("symbol") == F.col("_k"), "left_anti"))
        result.write.mode("overwrite").parquet(version_path(root, batch_id))
        prune_versions(spark, root, keep)
        if out_root:
            write_forecast_outputs(spark, spark.read.parquet(version_path(root, batch_id)), out_root)
    return run


def refreshed_forecast(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest forecasts of all keys (None before the first)."""
    newest = latest_version_below(spark, root, _ALL)
    return spark.read.parquet(newest) if newest else None
