"""Serving views over result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.functions.scalar import direction, fixed, fmt_number, hour_label, time_label

from tickwise.constants import DISPLAY_NAMES, NEWS_VIEW_SIZE  # noqa: E402


def display_name(symbol_col: str = "symbol"):
    m = F.create_map(*[x for kv in DISPLAY_NAMES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.element_at(m, F.col(symbol_col)), F.col(symbol_col))


def live_price_view(live: DataFrame) -> DataFrame:
    """V1: symbol, formatted price, direction, |change| with 2 decimals, local-currency price."""
    return live.select(
        "symbol", display_name().alias("name"),
        fmt_number("price_usd").alias("price"),
        direction("change_24h").alias("direction"),
        fixed(F.abs(F.col("change_24h")), 2).alias("change_abs"),
        fmt_number("price_idr").alias("price_local"))


def stats_view(stats: DataFrame) -> DataFrame:
    """V2 (statistics part): formatted mean / max / min / deviation."""
    return stats.select("symbol", *[fmt_number(c).alias(c) for c in
                                    ("rata_rata_usd", "tertinggi_usd", "terendah_usd", "std_deviasi")])


def volatility_view(vol: DataFrame) -> DataFrame:
    """V2 (volatility part): hour label, symbol, formatted mean |change|."""
    return vol.select(hour_label("jam").alias("hour"), "symbol",
                      F.concat(fmt_number("avg_volatilitas"), F.lit("%")).alias("volatility"))


def news_view(snapshot: DataFrame, k: int = NEWS_VIEW_SIZE) -> DataFrame:
    """The first k items of the ordered snapshot (title, link, published, source)."""
    return snapshot.limit(k).select("title", "link", F.coalesce("published", F.lit("")).alias("published"),
                                    F.coalesce("source", F.lit("")).alias("source"))


def series_align(result: DataFrame, key: str = "symbol") -> DataFrame:
    """U5 + V5: history then forecast as one labelled series per key. ``history_price`` is
    NULL on forecast positions; ``forecast_price`` is NULL on history positions except the last
    history point, which joins the two lines."""
    h = result.select(key, F.posexplode("history").alias("i", "p"), F.size("history").alias("nh"))
    h = h.select(key, (F.col("i") + 1).alias("position"), F.lit("history").alias("series"),
                 time_label(F.to_timestamp(F.col("p.timestamp"))).alias("label"),
                 F.col("p.price").alias("history_price"),
                 F.when(F.col("i") == F.col("nh") - 1, F.col("p.price")).alias("forecast_price"))
    f = result.select(key, F.posexplode("forecast").alias("i", "p"), F.size("history").alias("nh"))
    f = f.select(key, (F.col("nh") + F.col("i") + 1).alias("position"), F.lit("forecast").alias("series"),
                 time_label(F.to_timestamp(F.col("p.timestamp"))).alias("label"),
                 F.lit(None).cast("double").alias("history_price"), F.col("p.price").alias("forecast_price"))
    return h.unionByName(f)


def forecast_summary(result: DataFrame, key: str = "symbol") -> DataFrame:
    """V4 + V6: last price, last forecast, delta and delta %, point counts and model line."""
    last_h = F.element_at("history", -1)
    last_f = F.element_at("forecast", -1)
    diff = last_f["price"] - last_h["price"]
    pct = F.try_divide(diff, last_h["price"]) * F.lit(100.0)
    return result.select(
        key, last_h["price"].alias("last_price"), last_f["price"].alias("last_forecast"),
        diff.alias("delta"), pct.alias("delta_pct"),
        direction(diff).alias("direction"), fixed(F.abs(pct), 2).alias("delta_pct_text"),
        F.size("history").alias("history_points"), F.size("forecast").alias("forecast_points"),
        F.col("model.name").alias("model_name"), fixed(F.col("model.r2"), 4).alias("r2_text"),
        fmt_number(F.col("model.mae")).alias("mae_text"))
