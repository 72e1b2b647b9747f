"""Landing of keyed event streams.

Every micro-batch is written to folders of its own, ``batch=<id>/event_date=<date>``, with the arrival
columns of its rows (``sources/arrival.py``). A batch that is run again after a failure has the same id
and the same rows and overwrites its folder, so a row lands exactly once (T8, R13). Empty batches write
nothing (P11). Readers that filter on ``event_date`` prune folders.

One stream carries all topics (``start_pipeline``): each batch is routed to its topics' tables, and each
topic's live snapshot is made from the rows just written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickwise.functions.scalar import parse_ts
from tickwise.sources.arrival import ARRIVAL, BATCH, with_arrival

from tickwise.constants import LANDING_TRIGGER  # noqa: E402


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def with_event_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn("event_date", F.to_date(parse_ts(F.col(ts))))


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def write_batch(rows: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """One micro-batch of a landing table; a second run of the same batch replaces the first."""
    with_event_date(rows).write.mode("overwrite").partitionBy("event_date").format(fmt).save(batch_path(path, batch_id))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _start(stream: DataFrame, run: Callable[[DataFrame, int], None], tables: list[str], checkpoint: str,
           trigger: str | None, name: str | None) -> StreamingQuery:
    """A stream without its checkpoint would number its batches anew and overwrite landed ones."""
    spark = stream.sparkSession
    lost = [t for t in tables if not _exists(spark, f"{checkpoint}/metadata") and _exists(spark, batch_path(t, 0))]
    if lost:
        raise ValueError(f"{lost} hold batches of another checkpoint than {checkpoint}")
    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(w.queryName(name) if name else w, trigger).start()


def land(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = LANDING_TRIGGER,
         name: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """S7 + T1: append the stream to a landing table every ``trigger``; ``fmt`` is parquet by
    default (column pruning for the batch jobs) or ``json`` (JSON lines, R20)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = with_arrival(batch)
        write_batch(rows.select([c for c in rows.columns if not c.startswith("_")]), path, batch_id, fmt)
    return _start(stream, run, [path], checkpoint, trigger, name)


def poll_counts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows per poll (all rows of one poll share its time stamp)."""
    return df.groupBy(F.col(ts).alias("poll")).agg(F.count(F.lit(1)).alias("rows"))


def router(root: str, topics: dict[str, T.StructType], snapshot_fns: dict | None = None) -> Callable[[DataFrame, int], None]:
    """Writes the rows of each topic of a batch (``value``, ``_topic``, arrival columns) to
    ``{root}/<topic>`` and hands what was written to the topic's snapshot function. Messages that are not
    JSON are left out (S13), as are topics that are not listed."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = with_arrival(batch).persist()
        try:
            for topic, schema in topics.items():
                mine = rows.where((F.col("_topic") == topic) & F.get_json_object("value", "$").isNotNull())
                mine = mine.select(F.from_json("value", schema).alias("_v"), *ARRIVAL.fieldNames()).select("_v.*", *ARRIVAL.fieldNames())
                if mine.isEmpty():
                    continue
                write_batch(mine, f"{root}/{topic}", batch_id)
                if topic in (snapshot_fns or {}):
                    landed = spark.read.schema(T.StructType([*schema.fields, *ARRIVAL.fields])).parquet(batch_path(f"{root}/{topic}", batch_id))
                    snapshot_fns[topic](landed.drop("event_date"), batch_id)
        finally:
            rows.unpersist()
    return run


def start_pipeline(stream: DataFrame, root: str, topics: dict[str, T.StructType], trigger: str | None = LANDING_TRIGGER,
                   snapshot_fns: dict | None = None) -> StreamingQuery:
    """T2 + S8: one query over the topics of ``stream`` (``kafka.read_topics``): landing tables and live
    snapshots of all topics move on together, batch by batch."""
    return _start(stream, router(root, topics, snapshot_fns), [f"{root}/{t}" for t in topics], f"{root}/_checkpoints/route", trigger, "route")
