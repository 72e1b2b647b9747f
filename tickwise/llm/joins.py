"""Joins of many rows with one row per key, where a key may hold a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (one row per key) on ``keys``.

    A grouped table is already dealt by its keys, and a join that reuses that has nothing adaptive
    execution may split. A hash of the keys as one more join key gives both sides an exchange of
    their own, so the partitions of frequent keys are split."""
    extra = {"_spread": F.xxhash64(*keys)}
    return rows.withColumns(extra).join(table.withColumns(extra), ["_spread", *keys], how).drop("_spread")
