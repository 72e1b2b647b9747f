"""Measure task balance of the keyed series windows under a hot key.

The driver's events are re-keyed so that one key holds a third of all rows; the chunked
features and a whole-key window are run, and the per-task shuffle-read record counts of each
job are read back from Spark's event log (written to a fresh scratch folder).

Usage: python tools/skew_probe.py [sf_dir] [target_rows_per_chunk]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _events(logdir):
    for f in sorted(glob.glob(os.path.join(logdir, "*", "events*"))):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    target = int(argv[2]) if len(argv) > 2 else None
    from pyspark.sql import functions as F
    from tickwise.operators import series as S
    from tickwise.session import build_session
    from tickwise.sources.tables import price_events
    logdir = tempfile.mkdtemp(prefix="run-skew-")
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        # keep the 16 shuffle partitions visible: on small data AQE would merge them into one
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ev = price_events(spark, sf_dir)
    # one key gets a third of all rows (synthetic skew for this measurement only)
    hot = ev.withColumn("symbol", F.when(F.col("seq") % 3 == 0, F.lit("HOT")).otherwise(F.col("symbol")))
    base = S.base_series(hot)
    total = base.count()
    rows = target or S.TARGET_CHUNK_ROWS
    cut = S.plan_chunks(base, S.Series(), rows)
    hot_chunks = S._chunked(base, S.Series(), cut).where("symbol = 'HOT'").select(S.CHUNK).distinct().count()
    spark.sparkContext.setJobGroup("chunked", "chunked")
    S.series_features(base, target_rows=rows).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("whole_key", "whole_key")
    S.series_features_whole_key(base).write.format("noop").mode("overwrite").save()
    spark.stop()
    group_of_job, stage_group, reads = {}, {}, {}
    for e in _events(logdir):
        if e["Event"] == "SparkListenerJobStart":
            g = e.get("Properties", {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = g
        elif e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            reads.setdefault(e["Stage ID"], []).append(r)
    out = {"rows": total, "hot_key_chunks": hot_chunks, "shuffle_partitions": 16}
    for g in ("chunked", "whole_key"):
        stages = [s for s, gg in stage_group.items() if gg == g and s in reads and sum(reads[s]) > 0]
        biggest = max(stages, key=lambda s: sum(reads[s]))  # the stage that reads the full rows
        r = reads[biggest]
        out[g] = {"tasks": len(r), "max_task_records": max(r), "max_share": round(max(r) / max(1, total), 3)}
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv)
