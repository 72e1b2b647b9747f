"""Adapters from the driver's parquet tables to the pipeline's record shapes.

``events`` stands in for price ticks: key = event_type, price = value, time = ts,
tie-break = event_id, 24 h change = value - 50 (so it has both signs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.scalar import FX_USD_TO_IDR

# Offset that turns the positive ``value`` column into a signed 24 h change stand-in.
CHANGE_OFFSET = 50.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized price events: symbol, coin_id, price_usd, price_idr, change_24h, event_ts, seq."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("symbol"),
        F.lower("event_type").alias("coin_id"),
        F.col("value").alias("price_usd"),
        F.round(F.col("value") * F.lit(FX_USD_TO_IDR), 0).alias("price_idr"),
        (F.col("value") - F.lit(CHANGE_OFFSET)).alias("change_24h"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("event_id").alias("seq"),
    )


def news_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News items with a poll time: events rows as articles (event_ts, seq)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("string").alias("article_id"),
                     F.col("ts").cast("timestamp").alias("event_ts"),
                     F.col("event_id").alias("seq"))
