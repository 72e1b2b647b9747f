"""Freshness, volume, inventory and error-line checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.functions.scalar import ERROR_PATTERN, age_minutes
from tickwise.operators.lookup import join_small

from tickwise.constants import (FRESH_OK_MIN, FRESH_WARN_MIN, LOG_SHOW_LINES,  # noqa: E402
                                LOG_TAIL_LINES, ROOT_CAUSE_AGE_MIN)


def freshness(last_update: DataFrame, now: Column, expected: Sequence[str] | None = None,
              name: str = "name", ts: str = "last_ts") -> DataFrame:
    """Per output its age in whole minutes and ok (< 5) / warn (< 30) / stale; an
    expected output without any update is 'fail'. ``last_update``: name, last_ts."""
    lu = last_update.select(F.col(name).alias("name"), F.col(ts).alias("last_ts"))
    if expected is not None:
        exp = lu.sparkSession.createDataFrame([(e,) for e in expected], "name string")
        lu = join_small(exp, lu.withColumnRenamed("name", "_n"), F.col("name") == F.col("_n"), "left").drop("_n")
    age = age_minutes(now, F.col("last_ts"))
    status = (F.when(F.col("last_ts").isNull(), F.lit("fail"))
              .when(age < FRESH_OK_MIN, F.lit("ok"))
              .when(age < FRESH_WARN_MIN, F.lit("warn"))
              .otherwise(F.lit("stale")))
    return lu.select("name", age.alias("age_min"), status.alias("status"))


def output_last_update(spark, outputs: dict) -> DataFrame:
    """Newest file modification time per named output location (file contents are not read;
    a missing location gives no row, so :func:`freshness` with ``expected`` reports it 'fail')."""
    from pyspark.sql.utils import AnalysisException
    parts = []
    for name, path in outputs.items():
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        except AnalysisException:
            continue
        parts.append(files.select(F.lit(name).alias("name"), F.col("modificationTime").alias("last_ts")))
    if not parts:
        return spark.createDataFrame([], "name string, last_ts timestamp")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("name").agg(F.max("last_ts").alias("last_ts"))


def last_update_per(df: DataFrame, name: str, ts: str) -> DataFrame:
    """Newest event time per output/source (partial aggregate)."""
    return df.groupBy(F.col(name).alias("name")).agg(F.max(ts).alias("last_ts"))


def volume_status(volume: DataFrame, count_col: str = "messages") -> DataFrame:
    """Ok when the count is positive, else fail."""
    return volume.withColumn("status", F.when(F.col(count_col) > 0, F.lit("ok")).otherwise(F.lit("fail")))


def root_cause(fresh: DataFrame, volume: DataFrame, name: str = "name") -> DataFrame:
    """Stale for more than 10 minutes -> 'producer' fault when no messages arrived,
    else 'consumer' fault; otherwise 'healthy'. Inputs: N1 rows and (name, messages)."""
    v = volume.select(F.col(name).alias("_vn"), "messages")
    j = join_small(fresh, v, F.col(name) == F.col("_vn"), "left").drop("_vn")
    cause = (F.when(F.coalesce(F.col("age_min"), F.lit(10 ** 9)) > ROOT_CAUSE_AGE_MIN,
                    F.when(F.coalesce(F.col("messages"), F.lit(0)) == 0, F.lit("producer")).otherwise(F.lit("consumer")))
             .otherwise(F.lit("healthy")))
    return j.withColumn("cause", cause)


def error_lines(logs: DataFrame, source: str = "source", order: Sequence[str] = ("t",), line: str = "line",
                tail: int = LOG_TAIL_LINES, show: int = LOG_SHOW_LINES,
                pattern: str = ERROR_PATTERN) -> DataFrame:
    """N4 + O8 + F24: per source, among its last ``tail`` lines, the last ``show`` that match
    the error words (whole line, case-insensitive). Both cuts are ``row_number() <= k``,
    which Spark limits per map task before the shuffle (skew-safe top-k)."""
    from pyspark.sql import Window
    w = Window.partitionBy(source).orderBy(*[F.col(o).desc() for o in order])
    recent = logs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= tail)
    hits = recent.where(F.col(line).rlike(pattern)).drop("_r")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= show)
