"""Array maths used by the recursive forecast context."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["tail", "arr_sum", "arr_mean", "arr_pop_std", "last", "nth_from_end"]


def tail(arr: Column, n: int) -> Column:
    """Last n elements (all of them when shorter); never empty for a non-empty array."""
    start = F.greatest(F.lit(1), F.size(arr) - F.lit(n - 1))
    return F.slice(arr, start, F.lit(n))


def arr_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def arr_mean(arr: Column) -> Column:
    return arr_sum(arr) / F.size(arr)


def arr_pop_std(arr: Column) -> Column:
    """Population standard deviation of the elements (F17: power and square root)."""
    m = arr_mean(arr)
    sq = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m))
    return F.sqrt(sq / F.size(arr))


def last(arr: Column) -> Column:
    return F.element_at(arr, -1)


def nth_from_end(arr: Column, k: int, fallback: Column | None = None) -> Column:
    """Element k from the end (1 = last); ``fallback`` when the array is shorter."""
    v = F.when(F.size(arr) >= k, F.element_at(arr, -k))
    return v if fallback is None else F.coalesce(v, fallback)
