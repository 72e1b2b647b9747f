"""Latest-value, first-wins and newest-k snapshots.

Design: "one row per key" is an aggregate (``max_by`` / ``min_by`` over a struct of the row),
not a window. Aggregates combine map-side, so a key holding a third of all rows shrinks to
one row per map task before the shuffle. Ordered first-wins needs an explicit, total arrival
order; callers pass it as a list of columns (batch rank, file, position, offset, ...).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW = "_row"


def _pick(df: DataFrame, key: str | Sequence[str], order: Sequence[str], agg) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in df.columns]
    picked = (df.groupBy(*[F.col(k) for k in keys])
              .agg(agg(F.struct(*[F.col(c) for c in cols]),
                       F.struct(*[F.col(o) for o in order])).alias(_ROW)))
    return picked.select(*[F.col(f"{_ROW}.{c}").alias(c) for c in cols])


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole row with the greatest ``order`` per key (last arrival wins)."""
    return _pick(df, key, order, F.max_by)


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """A5: whole row with the smallest ``order`` per key (first arrival wins, unlike
    ``dropDuplicates`` which keeps an arbitrary row)."""
    return _pick(df, key, order, F.min_by)


def union_ranked(newer: DataFrame, older: DataFrame, rank_col: str = "_batch_rank") -> DataFrame:
    """Ordered union -- rows of ``newer`` sort before rows of ``older``."""
    return (newer.withColumn(rank_col, F.lit(0))
            .unionByName(older.withColumn(rank_col, F.lit(1)), allowMissingColumns=True))


def merge_first_wins(newer: DataFrame, older: DataFrame, key: str, arrival: Sequence[str],
                     rank_col: str = "_batch_rank") -> DataFrame:
    """U1 then A5 on ``key`` by (batch rank, arrival)."""
    return first_per_key(union_ranked(newer, older, rank_col), key, [rank_col, *arrival])


def newest_k(df: DataFrame, order: Sequence, k: int = 20) -> DataFrame:
    """First k rows by ``order`` (Column expressions; TakeOrderedAndProject: each task
    keeps its own k, so only k x tasks rows meet in the final merge)."""
    return df.orderBy(*order).limit(k)


def news_snapshot(batch: DataFrame, previous: DataFrame, arrival: Sequence[str], k: int = 20,
                  key: str = "article_id") -> DataFrame:
    """T5 body: newest batch first, oldest-first inside a batch (R15), unique ids, first k."""
    rank = "_batch_rank"
    merged = merge_first_wins(batch, previous, key, arrival, rank)
    return newest_k(merged, [F.col(rank), *[F.col(a) for a in arrival]], k).drop(rank)
