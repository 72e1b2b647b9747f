"""Batch aggregates over normalized events.

All are single ``groupBy`` aggregations: Spark runs them as partial (map-side) + final hash
aggregates, so a key holding a third of all rows is combined inside each map task before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def price_stats(prices: DataFrame, key: str = "symbol", price: str = "price_usd") -> DataFrame:
    """A1 + O1: per-key mean/max/min/sample-stddev rounded to 2 digits (F1: SQL ROUND, half-up,
    R6), row count; mean desc."""
    p = F.col(price)
    return (prices.groupBy(F.col(key).alias("symbol"))
            .agg(F.round(F.avg(p), 2).alias("rata_rata_usd"),
                 F.round(F.max(p), 2).alias("tertinggi_usd"),
                 F.round(F.min(p), 2).alias("terendah_usd"),
                 F.round(F.stddev_samp(p), 2).alias("std_deviasi"),
                 F.count(F.lit(1)).alias("jumlah_data"))
            .orderBy(F.col("rata_rata_usd").desc()))


def hourly_volatility(prices: DataFrame, ts: str = "event_ts", key: str = "symbol",
                      change: str = "change_24h") -> DataFrame:
    """A2 + O2: hour-of-day (F4, pooled over dates, R1) x key: mean |24h change| (F3, R2), rows."""
    return (prices.groupBy(F.hour(F.col(ts)).alias("jam"), F.col(key).alias("symbol"))
            .agg(F.round(F.avg(F.abs(F.col(change))), 4).alias("avg_volatilitas"),
                 F.count(F.lit(1)).alias("jumlah_data"))
            .orderBy(F.col("avg_volatilitas").desc()))


def hourly_news_count(news: DataFrame, ts: str = "event_ts") -> DataFrame:
    """A3 + O3: articles per hour of day (rows, duplicates included: R12)."""
    return (news.groupBy(F.hour(F.col(ts)).alias("jam"))
            .agg(F.count(F.lit(1)).alias("jumlah_artikel"))
            .orderBy(F.col("jumlah_artikel").desc()))


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The console preview rows (``show(n, False)`` prints the same)."""
    return df.limit(n)
