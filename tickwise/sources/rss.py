"""RSS items to news_event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.functions.scalar import article_id, left_chars
from tickwise.schemas import RSS_ITEM

from tickwise.constants import DEFAULT_TITLE, SUMMARY_CHARS  # noqa: E402


def normalize_news(items: DataFrame, poll_ts, source, title: str = "title", link: str = "link",
                   summary: str = "description", published: str = "pubDate",
                   keep: list[str] | None = None) -> DataFrame:
    """news_event columns from feed items; defaults for absent fields (P10). ``keep`` lists
    input columns passed through unchanged."""
    pts = F.col(poll_ts) if isinstance(poll_ts, str) else poll_ts
    src = F.col(source) if isinstance(source, str) else source
    return items.select(
        article_id(F.col(link)).alias("article_id"),
        F.coalesce(F.col(title), F.lit(DEFAULT_TITLE)).alias("title"),
        F.coalesce(F.col(link), F.lit("")).alias("link"),
        left_chars(F.coalesce(F.col(summary), F.lit("")), SUMMARY_CHARS).alias("summary"),
        F.coalesce(F.col(published), pts).alias("published"),
        src.cast("string").alias("source"),
        pts.cast("string").alias("timestamp"),
        *[F.col(k) for k in (keep or [])],
    )


def read_feeds(spark: SparkSession, paths, poll_ts: Column | None = None) -> DataFrame:
    """S17 + U4: every ``<item>`` of all feed files (the union of feeds is one multi-path
    read); a feed with any malformed item is skipped whole.
    ``source`` is the feed file; ``timestamp``/default ``published`` is ``poll_ts`` (default:
    the file's modification time as ISO string)."""
    schema = T.StructType(list(RSS_ITEM.fields) + [T.StructField("_corrupt_record", T.StringType())])
    items = (spark.read.format("xml").option("rowTag", "item").option("mode", "PERMISSIVE")
             .option("ignoreSurroundingSpaces", False)
             .option("columnNameOfCorruptRecord", "_corrupt_record").schema(schema).load(paths)
             .withColumn("_feed", F.col("_metadata.file_path"))
             .withColumn("_mtime", F.col("_metadata.file_modification_time")))
    # feeds with a malformed item, by partial aggregates: a feed of any size is one row per task. (The
    # link is read besides: Spark refuses scans whose only column is the corrupt-record column.)
    sign = F.when(F.col("_corrupt_record").isNotNull(), F.concat(F.lit("-"), F.coalesce("link", F.lit(""))))
    bad = items.groupBy("_feed").agg(F.max(sign).alias("_sign")).where(F.col("_sign").isNotNull()).select("_feed")
    good = items.join(bad, "_feed", "left_anti")
    pts = poll_ts if poll_ts is not None else F.date_format("_mtime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return normalize_news(good, pts, F.col("_feed"))
