"""Global places of rows in an order, without a task that holds all of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.session import materialize


def ranked(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` with ``place`` (from 1) by ``order``, which must tell all rows apart: ranges are sorted one
    by one and start at the number of rows before them."""
    spark = rows.sparkSession
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType())])

    def run(batches):
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at + 1, at + n + 1))],
                                             names=[*batch.schema.names, "_part", "_at"])
            at += n

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = materialize(spark, dealt.mapInArrow(run, schema), name)
    # one row per range, as many as partitions
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = laid.groupBy("_part").agg(F.count("*").alias("n")).select("_part", before.alias("_base"))
    return laid.join(F.broadcast(base), "_part").select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_base") + F.col("_at")).alias("place"))
