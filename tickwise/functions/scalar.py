"""Column-expression helpers. Everything here stays JVM-side (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "ERROR_PATTERN", "NULL_DASH", "FX_USD_TO_IDR",
    "parse_ts", "epoch_seconds", "to_double", "hour_of_day", "article_id", "iso_utc",
    "left_chars", "safe_ratio", "pct_change", "direction", "fmt_number", "time_label",
    "hour_label", "fixed", "age_minutes", "kb", "with_default",
]

from tickwise.constants import ERROR_PATTERN, FX_USD_TO_IDR, NULL_DASH  # noqa: E402


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_ts(c) -> Column:
    """ISO-8601 string (any offset) -> timestamp; NULL when malformed (ANSI-safe)."""
    return F.try_to_timestamp(_c(c))


def epoch_seconds(ts) -> Column:
    """timestamp -> whole epoch seconds as double (fraction dropped)."""
    return F.unix_timestamp(_c(ts).cast("timestamp")).cast("double")


def to_double(c) -> Column:
    """lenient cast to double."""
    return _c(c).try_cast("double")


def hour_of_day(ts) -> Column:
    """hour 0-23 in the session time zone (UTC)."""
    return F.hour(_c(ts))


def article_id(link, full: bool = False) -> Column:
    """First 8 hex chars of md5(link); a missing link hashes the empty string."""
    h = F.md5(F.coalesce(_c(link), F.lit("")))
    return h if full else F.substring(h, 1, 8)


def iso_utc(epoch) -> Column:
    """epoch seconds -> 'yyyy-MM-ddTHH:mm:ss+00:00'."""
    return F.date_format(F.timestamp_seconds(_c(epoch)), "yyyy-MM-dd'T'HH:mm:ssxxx")


def left_chars(c, n: int) -> Column:
    """first n characters."""
    return F.substring(_c(c), 1, n)


def safe_ratio(a, b, default: float | None = None) -> Column:
    """a / b, NULL (or ``default``) when b is 0 or NULL."""
    r = F.try_divide(_c(a), _c(b))
    return r if default is None else F.coalesce(r, F.lit(float(default)))


def pct_change(cur, prev) -> Column:
    """(cur - prev) / prev * 100, NULL when prev is 0/NULL."""
    return F.try_divide(_c(cur) - _c(prev), _c(prev)) * F.lit(100.0)


def direction(change) -> Column:
    """P12: 'up' when change >= 0 else 'down' (NULL stays NULL)."""
    c = _c(change)
    return F.when(c >= 0, F.lit("up")).when(c < 0, F.lit("down"))


def fmt_number(x) -> Column:
    """F19 + P14: grouped number with at most two decimals; NULL shows as a dash."""
    return F.coalesce(F.call_function("format_number", _c(x), F.lit("#,##0.##")), F.lit(NULL_DASH))


def time_label(ts) -> Column:
    """'MM/dd HH:mm'."""
    return F.date_format(_c(ts), "MM/dd HH:mm")


def hour_label(h) -> Column:
    """'<h>:00'."""
    return F.concat(_c(h).cast("string"), F.lit(":00"))


def fixed(x, digits: int = 2) -> Column:
    """fixed number of decimals as text; NULL shows as a dash."""
    x = _c(x)  # format_string renders NULL as the text "null", so test first
    return F.when(x.isNull(), F.lit(NULL_DASH)).otherwise(F.format_string(f"%.{digits}f", x))


def age_minutes(now, ts) -> Column:
    """whole minutes between two timestamps, floored."""
    secs = F.unix_micros(_c(now).cast("timestamp")) - F.unix_micros(_c(ts).cast("timestamp"))
    return F.floor(secs / F.lit(60_000_000)).cast("long")


def kb(nbytes) -> Column:
    """bytes -> whole KB, truncated."""
    return F.floor(_c(nbytes) / F.lit(1024)).cast("long")


def with_default(c, default) -> Column:
    """Value or a literal default when NULL/absent."""
    return F.coalesce(_c(c), F.lit(default))
