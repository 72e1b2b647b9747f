"""Vendor price payloads to price_event rows.

Input: one row per poll -- ``poll_ts`` (ISO string, P8) and the raw JSON text each vendor
returned (``payload_a``, ``payload_b``; NULL when the request failed). Everything is a
per-row expression: the coin list is a literal array, the fallback is decided inside the
row (first complete vendor wins for the whole poll), so there is no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.functions.scalar import FX_USD_TO_IDR
from tickwise.operators.lookup import literal_table
from tickwise.schemas import VENDOR_A, VENDOR_B

from tickwise.constants import CHANGE_DIGITS, COINS, LOCAL_PRICE_DIGITS, PRICE_DIGITS  # noqa: E402


def json_field(doc, key: str, default: float | None = None) -> Column:
    """F13 + F15: numeric member of a flat JSON object, with a default when absent/NULL."""
    c = F.col(doc) if isinstance(doc, str) else doc
    v = F.element_at(F.from_json(c, T.MapType(T.StringType(), T.DoubleType())), F.lit(key))
    return v if default is None else F.coalesce(v, F.lit(float(default)))


def _a_entry(m: Column, coin: Column) -> Column:
    return F.element_at(m, coin["coin_id"])


def _a_complete(m: Column, coin: Column) -> Column:
    """The coin, usd and idr must be present and non-NULL; a change key that is present
    must be non-NULL (absent means 0)."""
    e = _a_entry(m, coin)
    change_ok = (~F.map_contains_key(e, F.lit("usd_24h_change"))) | F.element_at(e, F.lit("usd_24h_change")).isNotNull()
    return F.coalesce(
        e.isNotNull() & F.element_at(e, F.lit("usd")).isNotNull()
        & F.element_at(e, F.lit("idr")).isNotNull() & change_ok, F.lit(False))


def _a_row(m: Column, coin: Column) -> Column:
    e = _a_entry(m, coin)
    return F.struct(coin["symbol"].alias("symbol"), coin["coin_id"].alias("coin_id"),
                    F.round(F.element_at(e, F.lit("usd")), PRICE_DIGITS).alias("price_usd"),
                    F.round(F.element_at(e, F.lit("idr")), LOCAL_PRICE_DIGITS).alias("price_idr"),
                    F.round(F.coalesce(F.element_at(e, F.lit("usd_24h_change")), F.lit(0.0)),
                            CHANGE_DIGITS).alias("change_24h"))


def _b_entry(raw: Column, coin: Column) -> Column:
    return F.element_at(F.element_at(raw, coin["symbol"]), F.lit("USD"))


def _b_complete(raw: Column, coin: Column) -> Column:
    """The symbol's USD entry with a non-NULL PRICE; a change key that is present must be
    non-NULL (absent means 0)."""
    e = _b_entry(raw, coin)
    change_ok = (~F.map_contains_key(e, F.lit("CHANGEPCT24HOUR"))) | F.element_at(e, F.lit("CHANGEPCT24HOUR")).isNotNull()
    return F.coalesce(e.isNotNull() & F.element_at(e, F.lit("PRICE")).isNotNull() & change_ok, F.lit(False))


def _b_row(raw: Column, coin: Column) -> Column:
    e = _b_entry(raw, coin)
    usd = F.round(F.element_at(e, F.lit("PRICE")), PRICE_DIGITS)
    return F.struct(coin["symbol"].alias("symbol"), coin["coin_id"].alias("coin_id"),
                    usd.alias("price_usd"),
                    F.round(usd * F.lit(float(FX_USD_TO_IDR)), LOCAL_PRICE_DIGITS).alias("price_idr"),  # P9
                    F.round(F.coalesce(F.element_at(e, F.lit("CHANGEPCT24HOUR")), F.lit(0.0)),
                            CHANGE_DIGITS).alias("change_24h"))


def normalize_polls(polls: DataFrame, coins: Sequence[tuple[str, str]] = COINS,
                    poll_ts: str = "poll_ts", payload_a: str = "payload_a",
                    payload_b: str = "payload_b") -> DataFrame:
    """S14 + S15 + S16: price_event rows (+ ``source``) per poll; vendor A when its payload is
    complete for every coin, else vendor B when complete, else no rows."""
    lst = literal_table(coins, ["symbol", "coin_id"])
    m = F.from_json(F.col(payload_a), VENDOR_A)
    raw = F.from_json(F.col(payload_b), VENDOR_B)["RAW"]
    a_ok = F.forall(lst, lambda c: _a_complete(m, c))
    b_ok = F.forall(lst, lambda c: _b_complete(raw, c))
    rows = (F.when(a_ok, F.transform(lst, lambda c: _a_row(m, c)))
            .when(b_ok, F.transform(lst, lambda c: _b_row(raw, c))))
    source = F.when(a_ok, F.lit("A")).when(b_ok, F.lit("B"))
    out = polls.select(F.col(poll_ts).alias("timestamp"), source.alias("source"),
                       F.explode_outer(rows).alias("r")).where(F.col("r").isNotNull())
    return out.select("r.*", "timestamp", "source")
