"""Explicit schemas for every record the pipeline reads or writes (no inference, see R9/§1.3)."""

from __future__ import annotations

from pyspark.sql import types as T

# price_event as produced per poll: one row per symbol, ISO-8601 UTC timestamp string.
PRICE_EVENT = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("coin_id", T.StringType()),
    T.StructField("price_usd", T.DoubleType()),
    T.StructField("price_idr", T.DoubleType()),
    T.StructField("change_24h", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

# news_event as produced per feed entry.
NEWS_EVENT = T.StructType([
    T.StructField("article_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# Vendor payload A: coin_id -> {usd, idr, usd_24h_change}. A map keeps "absent" and "null" apart.
VENDOR_A = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))

# Vendor payload B: RAW.<SYM>.USD.{PRICE, CHANGEPCT24HOUR}; the innermost level is a map too,
# so a member that is present but null is told apart from an absent one (as for vendor A).
VENDOR_B = T.StructType([
    T.StructField("RAW", T.MapType(T.StringType(), T.MapType(
        T.StringType(), T.MapType(T.StringType(), T.DoubleType())))),
])

# RSS <item> rows.
RSS_ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("pubDate", T.StringType()),
])

# Result tables.
STATS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("rata_rata_usd", T.DoubleType()),
    T.StructField("tertinggi_usd", T.DoubleType()),
    T.StructField("terendah_usd", T.DoubleType()),
    T.StructField("std_deviasi", T.DoubleType()),
    T.StructField("jumlah_data", T.LongType(), False),
])

VOLATILITY = T.StructType([
    T.StructField("jam", T.IntegerType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("avg_volatilitas", T.DoubleType()),
    T.StructField("jumlah_data", T.LongType(), False),
])

NEWS_VOLUME = T.StructType([
    T.StructField("jam", T.IntegerType()),
    T.StructField("jumlah_artikel", T.LongType(), False),
])

POINT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

MODEL_INFO = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
])

FORECAST_ENTRY = T.StructType([
    T.StructField("history", T.ArrayType(POINT)),
    T.StructField("forecast", T.ArrayType(POINT)),
    T.StructField("model", MODEL_INFO),
])

FRESHNESS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("age_min", T.LongType()),
    T.StructField("status", T.StringType()),
])

# Series feature columns, in the order the models consume them (M1).
FEATURE_COLS = ["pct_lag1", "pct_lag2", "pct_lag3", "ma_ratio", "ma_cross", "volatility", "momentum"]
