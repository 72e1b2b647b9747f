"""Lookups and anti-joins (J1-J3, P13, U3) with a size-checked broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes a side may have and still be broadcast, and the bytes counted for each column of a row
# besides the length of its text.
BROADCAST_MAX_BYTES = 64 << 20
FIELD_BYTES = 16


def has_at_most(df: DataFrame, n: int) -> bool:
    """True when ``df`` has at most n rows. Stops after n+1 rows, so it is cheap on big input."""
    return df.limit(n + 1).count() <= n


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when the rows of ``df`` take at most ``max_bytes``, texts and nested values counted by
    their length. Reads no more rows than could fit."""
    fixed = FIELD_BYTES * len(df.columns)
    most = max_bytes // fixed
    size = F.lit(fixed)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    rows, total = df.select(size.alias("_b")).limit(most + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum("_b"), F.lit(0))).first()
    return rows <= most and total <= max_bytes


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int = BROADCAST_MAX_BYTES, check: bool = False) -> DataFrame:
    """Join a side expected to be small.

    ``check=True`` (for base tables such as dimensions, cheap to size): broadcast only after
    a bounded pass proves at most ``max_bytes`` bytes. ``check=False`` (for derived sides --
    aggregates, coefficients -- which the pass would execute with their whole lineage once more):
    a plain join; adaptive execution measures the side at runtime and broadcasts it only
    when its actual size is under the broadcast threshold, and splits skewed partitions of
    the big side otherwise."""
    if check and fits_broadcast(small, max_bytes):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def lookup_name(df: DataFrame, dim: DataFrame, key: str, dim_key: str, name: str,
                out: str = "display_name", max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left lookup key -> name, falling back to the key itself."""
    d = dim.select(F.col(dim_key).alias("_lk"), F.col(name).alias("_lname"))
    j = join_small(df, d, df[key] == d["_lk"], "left", max_bytes, check=True)
    return j.withColumn(out, F.coalesce(F.col("_lname"), F.col(key).cast("string"))).drop("_lk", "_lname")


def unseen(df: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None,
           max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Rows whose key is not among ``seen``. The seen side is reduced to distinct
    keys first (map-side combine), so a hot key there costs one row per task."""
    sk = seen_key or key
    ids = seen.select(F.col(sk).alias("_sk")).where(F.col("_sk").isNotNull()).distinct()
    return join_small(df, ids, df[key] == ids["_sk"], "left_anti", max_bytes)


def literal_table(rows: Sequence[tuple], names: Sequence[str]) -> Column:
    """A small fixed lookup list as an array<struct> literal (explode it to join without a shuffle)."""
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])


def keep_best_source(df: DataFrame, group: str, prio: str, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Per group keep only rows of the best (lowest) priority present in that group.
    The per-group minimum is a partial aggregate; it is joined back on the group key."""
    best = df.groupBy(F.col(group).alias("_g")).agg(F.min(prio).alias("_best"))
    j = join_small(df, best, (df[group] == best["_g"]) & (df[prio] == best["_best"]), "left_semi", max_bytes)
    return j
