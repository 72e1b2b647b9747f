"""Mergeable states of the batch aggregates.

A state is one row per key: rows ``n``, measured values ``m``, their sum ``total``, sum of squared
deviations ``m2``, ``lo`` and ``hi``. Two states of one key merge without the rows they were made from and
without the cancellation of raw sums of squares, so results that cover all rows ever seen follow from the
stored states and the new rows alone. Null keys are a group like any other; null values count as rows
but are not measured (as in ``avg`` or ``stddev_samp``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FIELDS = ("n", "m", "total", "m2", "lo", "hi")


def summarise(rows: DataFrame, keys: dict[str, Column], value: Column) -> DataFrame:
    """States of ``rows``: partial (map-side) and final aggregates, a hot key is one buffer per task."""
    v = value.cast("double")
    return rows.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("m"), F.coalesce(F.sum(v), F.lit(0.0)).alias("total"),
        F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias("m2"), F.min(v).alias("lo"), F.max(v).alias("hi"))


def merge(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """States of the rows of both sides; each side has a key once at most."""
    side = lambda df, k: df.select(*keys, F.lit(k).alias("_side"), F.struct(*_FIELDS).alias("_s"))
    both = side(stored, 0).unionByName(side(new, 1)).groupBy(*keys).agg(
        *[F.max(F.when(F.col("_side") == k, F.col("_s"))).alias(name) for k, name in enumerate("ab")])
    num = lambda name, zero: [F.coalesce(F.col(f"{x}.{name}"), F.lit(zero)) for x in "ab"]
    (na, nb), (ma, mb), (ta, tb), (qa, qb) = num("n", 0), num("m", 0), num("total", 0.0), num("m2", 0.0)
    apart = F.try_divide(tb, mb) - F.try_divide(ta, ma)     # null where a side measured nothing
    between = F.coalesce(apart * apart * F.try_divide((ma * mb).cast("double"), (ma + mb).cast("double")), F.lit(0.0))
    return both.select(*keys, (na + nb).alias("n"), (ma + mb).alias("m"), (ta + tb).alias("total"), (qa + qb + between).alias("m2"),
                       F.least("a.lo", "b.lo").alias("lo"), F.greatest("a.hi", "b.hi").alias("hi"))


def _mean() -> Column:
    return F.try_divide(F.col("total"), F.col("m"))


@dataclass(frozen=True)
class Running:
    """A result kept as states: its keys, the measured value, the columns shown and their digits."""
    keys: dict[str, Callable[[], Column]]
    value: Callable[[], Column]
    columns: Callable[[DataFrame, int], DataFrame]
    digits: int = 0

    def show(self, states: DataFrame, digits: int | None = None) -> DataFrame:
        return self.columns(states, self.digits if digits is None else digits)

    def of(self, rows: DataFrame) -> DataFrame:
        return summarise(rows, {k: c() for k, c in self.keys.items()}, self.value())

    def merged(self, stored: DataFrame, rows: DataFrame) -> DataFrame:
        return merge(stored, self.of(rows), list(self.keys))


_hour = lambda: F.hour("event_ts")
_symbol = lambda: F.col("symbol")

PRICE_STATS = Running({"symbol": _symbol}, lambda: F.col("price_usd"), lambda s, d: s.select(
    "symbol", F.round(_mean(), d).alias("rata_rata_usd"), F.round("hi", d).alias("tertinggi_usd"), F.round("lo", d).alias("terendah_usd"),
    F.round(F.sqrt(F.try_divide(F.col("m2"), F.when(F.col("m") > 1, F.col("m") - 1))), d).alias("std_deviasi"),
    F.col("n").alias("jumlah_data")).orderBy(F.col("rata_rata_usd").desc()), 2)
HOURLY_VOLATILITY = Running({"jam": _hour, "symbol": _symbol}, lambda: F.abs(F.col("change_24h")), lambda s, d: s.select(
    "jam", "symbol", F.round(_mean(), d).alias("avg_volatilitas"), F.col("n").alias("jumlah_data")).orderBy(F.col("avg_volatilitas").desc()), 4)
HOURLY_NEWS = Running({"jam": _hour}, lambda: F.lit(None), lambda s, _: s.select(
    "jam", F.col("n").alias("jumlah_artikel")).orderBy(F.col("jumlah_artikel").desc()))

# Results by the topic whose rows feed them.
RESULTS = {"api": {"statistik": PRICE_STATS, "volatilitas": HOURLY_VOLATILITY}, "rss": {"berita": HOURLY_NEWS}}
