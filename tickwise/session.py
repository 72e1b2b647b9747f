"""Session construction and shared-storage scratch paths."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_SCRATCH = "spark.tickwise.localScratch"

# Settings every job relies on: UTC hour-of-day semantics (R1), ANSI on with try_* guards (R9),
# adaptive execution for partition coalescing and skew splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows may hold long texts: small batches bound the memory of a Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # a join that needs few rows of a large scan filters the scan by a Bloom filter (8 MB at most)
    # of the small side's keys before the exchange
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "16MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    # each statement's shuffle files go when it ends; lineage is cut by written tables, not by shuffles
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # stream state off the heap and on disk, uploaded as changes; sessions merged before their exchange
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tickwise",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    for k, v in (extra or {}).items():  # explicit settings of the caller win
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings to an existing session (e.g. one the driver created)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for scratch tables: the cluster's ``spark.checkpoint.dir`` (or the checkpoint
    folder set on the context). Only a session with a ``local`` master may go without; it gets a
    folder of its own, remembered in the session. On a cluster, executors and driver would each
    write to their own disks, so a missing setting is an error there."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or spark.conf.get(LOCAL_SCRATCH, None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tickwise-scratch-")
        spark.conf.set(LOCAL_SCRATCH, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(spark: SparkSession, df, name: str):
    """Cut lineage by writing ``df`` as parquet below the shared checkpoint folder and reading
    it back. Survives executor loss (unlike local checkpoints) and is reused by later jobs."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, df) -> None:
    """Delete the files of a table that ``materialize`` wrote and that no plan reads any more."""
    jvm, root = spark.sparkContext._jvm, checkpoint_root(spark).rstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if root.split(":", 1)[-1].lstrip("/") not in folder:
            raise ValueError(f"{folder} is not a scratch table")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
