"""Keyed time-series windows that stay balanced under key skew.

The original computes its lag / moving-window features with one window per key ordered by
time. On a cluster that makes a key holding a third of all rows a single task. Here a key with
more rows than a task should hold is cut along time into chunks of about so many rows; windows
run per (key, chunk). Every other key is one chunk. Each chunk of a cut key is given a *halo*:
the last ``halo`` rows of the key before the chunk starts, taken from per-chunk tails (a
partial-limited window, so only ``halo`` rows per chunk and map task are shuffled). With the
halo in place, every bounded look-back (lags up to 5, frames up to 14 rows) sees exactly the
rows a single whole-key window would see; halo rows are dropped after the window. Global row
positions inside a key (needed for the chronological split and the tails) come from per-chunk
counts and a prefix sum over the chunk summary, never from a whole-key window.

The cuts (:func:`plan_chunks`) come from row counts per (key, hour) of the cut keys, so quiet
hours share a chunk, busy ones are divided, and halo rows are few against a chunk's rows. Tests
also force one width in seconds on all keys to exercise short chunks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwise.functions.scalar import epoch_seconds, pct_change, safe_ratio
from tickwise.operators.lookup import join_small
from tickwise.session import materialize

# Rows of look-back the features need: ma14 = 13 preceding rows; the leak-free variant one more.
FEATURE_HALO = 14
# Rows per (key, chunk) when the cuts are planned from the data; a key with no more is not cut.
TARGET_CHUNK_ROWS = 1_000_000
MIN_CHUNK_ROWS = 100_000
PLAN_BUCKET_S = 3600.0    # grain of the row counts the cuts are planned from
PARTS = 1 << 20           # chunk numbers set aside for the divisions of one busy hour
# P5 / P6 / P7 guards, W9 split, W10 / W11 tails, A9 interval.
from tickwise.constants import (CONTEXT_POINTS, DEFAULT_INTERVAL, HISTORY_POINTS,  # noqa: E402,F401
                                INTERVAL_DIFFS, MIN_ROWS_PER_KEY, MIN_ROWS_TOTAL, MIN_VAL_ROWS,
                                TRAIN_FRACTION)

CHUNK = "_chunk"
HALO_FLAG = "_halo"


@dataclass(frozen=True)
class Series:
    key: str = "symbol"
    ts: str = "ts"            # epoch seconds (double)
    value: str = "price"
    tiebreak: str = "seq"

    def order(self) -> list[Column]:
        return [F.col(self.ts), F.col(self.tiebreak)]


def base_series(prices: DataFrame, key: str = "symbol", price: str = "price_usd",
                ts: str = "event_ts", tiebreak: str = "seq") -> DataFrame:
    """P1 + P2: (symbol, price double, ts whole epoch seconds, seq), rows with any NULL/NaN dropped.
    The NULL tests on the source columns are pushed into the scan; the cast/NaN part follows."""
    prices = prices.where(F.col(key).isNotNull() & F.col(price).isNotNull()
                          & F.col(ts).isNotNull() & F.col(tiebreak).isNotNull())
    out = prices.select(F.col(key).alias("symbol"),
                        F.col(price).try_cast("double").alias("price"),
                        epoch_seconds(F.col(ts)).alias("ts"),
                        F.col(tiebreak).alias("seq"))
    return out.na.drop()


def plan_chunks(df: DataFrame, s: Series, target_rows: int = TARGET_CHUNK_ROWS) -> DataFrame | None:
    """Where to cut the keys that hold more rows than a chunk should: one row per (key, hour) of
    these keys with the hour's first chunk (``_c0``), its first time (``_lo``) and, in hours with
    more rows than a chunk, the length of its divisions (``_w`` seconds, ``_p`` of them). None
    when no key is that large. ``target_rows`` is lowered on smaller data so that cores get about
    3 chunks each. Partial aggregates only; the driver sees two numbers."""
    per_key = df.groupBy(s.key).agg(F.count(F.lit(1)).alias("_n"))
    total, largest = per_key.agg(F.sum("_n"), F.max("_n")).first()
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    rows = max(min(MIN_CHUNK_ROWS, target_rows), min(target_rows, (total or 0) // (3 * cores)))
    if (largest or 0) <= rows:
        return None
    large = df.join(per_key.where(F.col("_n") > rows).select(s.key), s.key, "left_semi")
    hours = large.groupBy(F.col(s.key).alias("_hk"), F.floor(F.col(s.ts) / F.lit(PLAN_BUCKET_S)).alias("_h")).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min(s.ts).alias("_lo"), F.max(s.ts).alias("_hi"))
    before = F.sum("_cnt").over(Window.partitionBy("_hk").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1))
    parts = F.ceil(F.col("_cnt") / F.lit(rows))
    busy = (F.col("_cnt") > rows) & (F.col("_hi") > F.col("_lo"))
    plan = hours.select("_hk", "_h", (F.floor(F.coalesce(before, F.lit(0)) / F.lit(rows)) * PARTS).cast("long").alias("_c0"), "_lo",
                        F.when(busy, (F.col("_hi") - F.col("_lo")) / parts).alias("_w"), F.when(busy, parts).alias("_p"))
    return materialize(df.sparkSession, plan, "chunk-plan")


def _chunked(df: DataFrame, s: Series, cut: DataFrame | float | None) -> DataFrame:
    """Rows with their chunk: by the plan, by one width in seconds, or one chunk per key (None)."""
    if cut is None:
        return df.withColumn(CHUNK, F.lit(0).cast("long"))
    if not isinstance(cut, DataFrame):
        return df.withColumn(CHUNK, F.floor(F.col(s.ts) / F.lit(float(cut))).cast("long"))
    on = (df[s.key] == cut["_hk"]) & (F.floor(df[s.ts] / F.lit(PLAN_BUCKET_S)) == cut["_h"])
    part = F.least(F.floor((F.col(s.ts) - F.col("_lo")) / F.col("_w")), F.col("_p") - 1)
    chunk = F.coalesce(F.col("_c0") + F.when(F.col("_p").isNotNull(), part).otherwise(F.lit(0)), F.lit(0))
    return join_small(df, cut, on, "left", check=True).select(*[df[c] for c in df.columns], chunk.cast("long").alias(CHUNK))


def with_halo(df: DataFrame, s: Series, cut: DataFrame | float | None, halo: int) -> DataFrame:
    """Rows plus, per (key, chunk), the last ``halo`` rows of the key before that chunk
    (flag ``_halo``). Windows over (key, chunk) on this frame equal whole-key windows for
    look-backs up to ``halo`` rows. Keys that are not cut have no halo."""
    c = _chunked(df, s, cut)
    if cut is None:
        return c.withColumn(HALO_FLAG, F.lit(False))
    parts = c
    if isinstance(cut, DataFrame):
        parts = c.join(cut.select(F.col("_hk").alias(s.key)).distinct(), s.key, "left_semi")
    # (ts, tiebreak) first so that the natural struct order is time order
    cols = [s.ts, s.tiebreak] + [x for x in df.columns if x not in (s.key, s.ts, s.tiebreak)]
    desc = Window.partitionBy(s.key, CHUNK).orderBy(F.col(s.ts).desc(), F.col(s.tiebreak).desc())
    tails = (parts.withColumn("_r", F.row_number().over(desc)).where(F.col("_r") <= halo)
             .groupBy(s.key, CHUNK)
             .agg(F.collect_list(F.struct(*[F.col(x) for x in cols])).alias("_tail")))
    prev = Window.partitionBy(s.key).orderBy(CHUNK).rowsBetween(-halo, -1)
    halos = (tails.select(s.key, CHUNK,
                          F.flatten(F.collect_list("_tail").over(prev)).alias("_prev"))
             .where(F.size("_prev") > 0))
    # keep the newest ``halo`` rows of the collected predecessors
    ordered = F.array_sort(F.col("_prev"))
    keep = F.slice(ordered, F.greatest(F.lit(1), F.size(ordered) - F.lit(halo - 1)), F.lit(halo))
    halo_rows = (halos.select(s.key, CHUNK, F.explode(keep).alias("_h"))
                 .select(s.key, CHUNK, *[F.col(f"_h.{x}").alias(x) for x in cols])
                 .withColumn(HALO_FLAG, F.lit(True)))
    return c.withColumn(HALO_FLAG, F.lit(False)).unionByName(halo_rows)


def _feature_columns(s: Series, w, leak_free: bool = False) -> list[tuple[str, Column]]:
    """W1-W8 as (name, expression) in dependency order; ``w`` orders rows by (time, tie-break)
    (R8) -- the window's ordering replaces the original's explicit sorts (O4, O5).

    W1 percent change; W2 lagged changes 1-3; W3/W4 moving averages over 7/14 rows (partial
    frames allowed); W5 price / ma7; W6 ma7 / ma14; W7 sample deviation of the change over 7
    rows; W8 momentum against 5 rows back. Divisions are ``try_divide`` (R9)."""
    p = F.col(s.value)
    feats = [
        ("pct_change", pct_change(p, F.lag(p, 1).over(w))),
        ("pct_lag1", F.lag("pct_change", 1).over(w)),
        ("pct_lag2", F.lag("pct_change", 2).over(w)),
        ("pct_lag3", F.lag("pct_change", 3).over(w)),
        ("ma7", F.avg(p).over(w.rowsBetween(-6, 0))),
        ("ma14", F.avg(p).over(w.rowsBetween(-13, 0))),
        ("ma_ratio", safe_ratio(p, F.col("ma7"))),
        ("ma_cross", safe_ratio(F.col("ma7"), F.col("ma14"))),
        ("volatility", F.stddev_samp("pct_change").over(w.rowsBetween(-6, 0))),
        ("momentum", pct_change(p, F.lag(p, 5).over(w))),
    ]
    if leak_free:  # R3: features of row t built from rows up to t-1 only
        for name in ("ma_ratio", "ma_cross", "volatility", "momentum"):
            feats.append((name, F.lag(name, 1).over(w)))
    return feats


def _apply(df: DataFrame, exprs: list[tuple[str, Column]]) -> DataFrame:
    for name, e in exprs:
        df = df.withColumn(name, e)
    return df


FEATURE_OUT = ["pct_change", "pct_lag1", "pct_lag2", "pct_lag3", "ma7", "ma14",
               "ma_ratio", "ma_cross", "volatility", "momentum"]


def series_features(base: DataFrame, s: Series = Series(), width: float | None = None,
                    leak_free: bool = False, target_rows: int = TARGET_CHUNK_ROWS) -> DataFrame:
    """W1-W8 + P2: feature rows per key (rows with any NULL/NaN dropped), skew-balanced.

    Output keeps the input columns, adds the feature columns and ``_chunk``."""
    cut = plan_chunks(base, s, target_rows) if width is None else width
    h = with_halo(base, s, cut, FEATURE_HALO + (1 if leak_free else 0))
    w = Window.partitionBy(s.key, CHUNK).orderBy(*s.order())
    out = _apply(h, _feature_columns(s, w, leak_free)).where(~F.col(HALO_FLAG)).drop(HALO_FLAG)
    return out.na.drop(subset=[*base.columns, *FEATURE_OUT])


def series_features_whole_key(base: DataFrame, s: Series = Series(), leak_free: bool = False) -> DataFrame:
    """The same features with one window per key (the original's plan). Reference
    implementation for tests; skews with hot keys."""
    w = Window.partitionBy(s.key).orderBy(*s.order())
    return _apply(base, _feature_columns(s, w, leak_free)).na.drop()


def with_positions(df: DataFrame, s: Series = Series(), width: float | None = None,
                   key_extra: DataFrame | None = None) -> DataFrame:
    """Adds ``pos`` (1-based time order inside the key) and ``n`` (rows of the key).

    Uses the frame's ``_chunk`` when present; positions are per-chunk row numbers plus the
    prefix sum of earlier chunk sizes (from a one-row-per-chunk summary). ``key_extra``
    (one row per key, e.g. :func:`key_sizes`) is attached through that small summary, so the
    rows are only ever joined on (key, chunk) -- the partitioning they already have."""
    if CHUNK not in df.columns:
        df = _chunked(df, s, plan_chunks(df, s) if width is None else width)
    w = Window.partitionBy(s.key, CHUNK).orderBy(*s.order())
    ranked = df.withColumn("_rn", F.row_number().over(w))
    sizes = df.groupBy(s.key, CHUNK).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = _offsets(sizes, s, key_extra)
    j = ranked.join(offsets, (ranked[s.key] == offsets["_k"]) & (ranked[CHUNK] == offsets["_c"]))
    return j.withColumn("pos", (F.col("_off") + F.col("_rn")).cast("long")).drop("_k", "_c", "_off", "_rn")


def has_rows(df: DataFrame, n: int) -> bool:
    """P5: at least n rows (stops counting at n)."""
    return df.limit(n).count() >= n


def _offsets(sizes: DataFrame, s: Series, key_extra: DataFrame | None) -> DataFrame:
    """Per (key, chunk): rows in earlier chunks of the key (``_off``) and rows of the key (``n``)."""
    kw = Window.partitionBy(s.key).orderBy(CHUNK)
    offsets = sizes.select(
        F.col(s.key).alias("_k"), F.col(CHUNK).alias("_c"),
        F.coalesce(F.sum("_cnt").over(kw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(s.key)).alias("n"))
    if key_extra is not None:
        ke = key_extra.withColumnRenamed(s.key, "_ek")
        offsets = offsets.join(ke, offsets["_k"] == ke["_ek"], "left").drop("_ek")
    return offsets


def feature_table(spark, base: DataFrame, s: Series = Series(), width: float | None = None,
                  leak_free: bool = False, target_rows: int = TARGET_CHUNK_ROWS,
                  materialize_rows: bool = True) -> DataFrame:
    """Feature rows with ``pos``, ``n`` and ``raw_n`` -- the table every later step reads.

    One full shuffle: the (key, chunk) windows compute the features and, in the same pass,
    each row's number inside its chunk. The rows are then written once to the shared
    checkpoint folder (``materialize_rows``), so nothing downstream re-runs the windows. Global
    positions add the chunk's offset from a one-row-per-chunk summary, written once too and
    broadcast after a byte check (it has about rows / ``target_rows`` entries), so the rows are
    never shuffled again and the input is not read by any later step."""
    f = series_features(base, s, width, leak_free, target_rows)
    f = f.withColumn("_rn", F.row_number().over(Window.partitionBy(s.key, CHUNK).orderBy(*s.order())))
    if materialize_rows:
        f = materialize(spark, f, "features")
    sizes = f.groupBy(s.key, CHUNK).agg(F.max("_rn").alias("_cnt"))
    offsets = _offsets(sizes, s, key_sizes(base, s.key))
    if materialize_rows:    # finished: no later step scans the input or counts the chunks again
        offsets = materialize(spark, offsets, "feature-offsets")
    j = join_small(f, offsets, (f[s.key] == offsets["_k"]) & (f[CHUNK] == offsets["_c"]), check=True)
    return j.withColumn("pos", (F.col("_off") + F.col("_rn")).cast("long")).drop("_k", "_c", "_off", "_rn")


def key_sizes(base: DataFrame, key: str = "symbol") -> DataFrame:
    """Raw rows per key (partial aggregate)."""
    return base.groupBy(key).agg(F.count(F.lit(1)).alias("raw_n"))


def chrono_split(feats: DataFrame, s: Series = Series(),
                 min_rows: int = MIN_ROWS_PER_KEY, min_val: int = MIN_VAL_ROWS,
                 train_fraction: float = TRAIN_FRACTION) -> DataFrame:
    """W9 + P6 + P7: first floor(0.8 n) feature rows train, the rest validation; keys with
    fewer than ``min_rows`` raw rows or fewer than ``min_val`` validation rows are dropped
    (R7: a key needs 26 raw rows -- 5 are lost to the lags, and 25 leave only 4 validation rows).
    ``feats`` carries ``pos``/``n``/``raw_n`` (``with_positions(..., key_extra=key_sizes(base))``)."""
    n_train = F.floor(F.col("n") * F.lit(train_fraction)).cast("long")
    j = feats
    return (j.withColumn("n_train", n_train)
            .where((F.col("raw_n") >= min_rows) & (F.col("n") - F.col("n_train") >= min_val))
            .withColumn("split", F.when(F.col("pos") <= F.col("n_train"), F.lit("train")).otherwise(F.lit("val"))))


def tail_rows(feats: DataFrame, k: int) -> DataFrame:
    """W10/W11/O8 shape: the last k rows of each key (needs ``pos``/``n``), no window."""
    return feats.where(F.col("pos") > F.col("n") - F.lit(k))


def sampling_interval(feats: DataFrame, s: Series = Series(), diffs: int = INTERVAL_DIFFS,
                      default: int = DEFAULT_INTERVAL) -> DataFrame:
    """Mean of the last up-to-``diffs`` time steps, rounded half-even; ``default`` for one row.
    The mean telescopes to (ts_last - ts_first) / m over the last m+1 rows."""
    first_pos = F.greatest(F.lit(1), F.col("n") - F.lit(diffs))
    t = tail_rows(feats, diffs + 1)
    g = t.groupBy(s.key).agg(F.max("n").alias("n"),
                             F.max_by(s.ts, "pos").alias("_last"),
                             F.max(F.when(F.col("pos") == first_pos, F.col(s.ts))).alias("_first"),
                             F.max("pos").alias("_pmax"))
    m = F.col("n") - F.greatest(F.lit(1), F.col("n") - F.lit(diffs))
    val = F.when(F.col("n") > 1, F.bround((F.col("_last") - F.col("_first")) / m, 0)).otherwise(F.lit(float(default)))
    return g.select(F.col(s.key), val.cast("long").alias("interval_s"), F.col("_last").alias("last_ts"))
