"""Arrival order (R8, W12): which row came first, kept with the rows.

A row's place is (batch, arrival_time, arrival_source, arrival_block, arrival_row): the micro-batch that
landed it, then the time and path of its file and its place in it, or its topic partition and offset.
``with_arrival`` computes the last four where the rows are read, before any exchange; landing stores
them, so later readers order rows alike at any partitioning and after a replay. Places within a file
follow its splits (``arrival_block``, their byte offsets) and the order inside a split
(``arrival_row``, ascending but not dense). Offsets order the rows of one topic partition, where all
messages of a key are; partitions follow each other by number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARRIVAL = T.StructType([
    T.StructField("arrival_time", T.TimestampType()),
    T.StructField("arrival_source", T.StringType()),
    T.StructField("arrival_block", T.LongType()),
    T.StructField("arrival_row", T.LongType()),
])
BATCH = "batch"
_READ = ("_file_mtime", "_file", "_block", "_pos")      # what readers of foreign files attach


def with_arrival(df: DataFrame) -> DataFrame:
    """Rows with the ``ARRIVAL`` columns, from their source's columns (or, without any, the order in
    which the rows are read). Rows that have them keep them."""
    if set(ARRIVAL.fieldNames()) <= set(df.columns):
        return df
    at = lambda name, kind: F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
    if "_offset" in df.columns:
        source, row = F.format_string("%s/%06d", F.col("_topic"), F.col("_partition")), F.col("_offset").cast("long")
    else:
        source = at("_file", "string")
        row = F.col("_pos").cast("long") if "_pos" in df.columns else F.monotonically_increasing_id()
    return df.withColumns({"arrival_time": at("_file_mtime", "timestamp"), "arrival_source": source,
                           "arrival_block": at("_block", "long"), "arrival_row": row})


def arrival_order(df: DataFrame) -> list[str]:
    """Names of the columns that order the rows by arrival."""
    return [c for c in (BATCH, *ARRIVAL.fieldNames(), *_READ) if c in df.columns]
