"""Keyed message streams (S5, S6, S8). One function hides the transport: ``kafka`` in
deployment, a JSON directory in tests (the Kafka connector jar is not part of this install)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_topic(spark: SparkSession, topic: str, schema: T.StructType, fmt: str = "kafka",
               bootstrap: str | None = None, path: str | None = None,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows of ``topic`` parsed with an explicit schema, plus arrival columns
    (``_topic``, ``_partition``, ``_offset`` for Kafka; file and line position for files)."""
    if fmt == "kafka":
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
               .option("subscribe", topic).option("startingOffsets", "earliest").load())
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("v"),
                          F.col("topic").alias("_topic"), F.col("partition").alias("_partition"),
                          F.col("offset").alias("_offset")).select("v.*", "_topic", "_partition", "_offset")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(path)
    return df.select("*", F.lit(topic).alias("_topic"), *_file_columns())


def _file_columns() -> list:
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_file_mtime"),
            F.col("_metadata.file_block_start").alias("_block")]


def read_topics(spark: SparkSession, sources: dict[str, str], fmt: str = "kafka", bootstrap: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """S5 + T2: the messages of several topics as one stream: ``value`` (JSON text), ``_topic`` (the
    name in ``sources``) and arrival columns. ``sources`` maps a topic's name to the Kafka topic, or to
    the folder of its JSON-lines files."""
    if fmt == "kafka":
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
               .option("subscribe", ",".join(sources.values())).option("startingOffsets", "earliest").load())
        names = F.create_map(*[F.lit(x) for name, topic in sources.items() for x in (topic, name)])
        return raw.select(F.col("value").cast("string").alias("value"), names[F.col("topic")].alias("_topic"),
                          F.col("partition").alias("_partition"), F.col("offset").alias("_offset"))
    out = None
    for name, path in sources.items():
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        part = reader.text(path).select("value", F.lit(name).alias("_topic"), *_file_columns())
        out = part if out is None else out.unionByName(part)
    return out


def to_records(df: DataFrame, key: str) -> DataFrame:
    """(key, value) pairs -- key column as string, the whole row as JSON."""
    data = [c for c in df.columns if not c.startswith("_")]
    return df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in data])).alias("value"))


def write_topic(df: DataFrame, topic: str, key: str, bootstrap: str) -> None:
    """Publish keyed JSON with all-replica acks and idempotent delivery."""
    (to_records(df, key).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
     .option("kafka.acks", "all").option("kafka.enable.idempotence", "true").save())


def message_volume(log: DataFrame, topic: str = "topic", partition: str = "partition",
                   offset: str = "offset") -> DataFrame:
    """A10: messages per topic = sum over partitions of (max offset + 1)."""
    ends = log.groupBy(topic, partition).agg((F.max(offset) + F.lit(1)).alias("_end"))
    return ends.groupBy(topic).agg(F.sum("_end").cast("long").alias("messages"))
