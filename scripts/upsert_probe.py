"""Partition-scoped vs whole-table upsert on derived events.

Replicates the sf0.1 events R times (keys shifted, dates spread), loads them
into a PartitionedTable (by event date) and a SnapshotTable, then upserts a
batch that changes the last two dates only, and reports time and files
written by each.

    python scripts/upsert_probe.py [sf_dir] [R]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.session import build_session, fresh_dir  # noqa: E402
from tidemark.sources.files import hadoop_fs  # noqa: E402
from tidemark.sources.partitioned import PartitionedTable  # noqa: E402
from tidemark.sources.snapshots import SnapshotTable  # noqa: E402


def count_files(spark, path: str) -> tuple[int, int]:
    """(parquet files, bytes) under ``path``."""
    fs, p = hadoop_fs(spark, path)
    it = fs.listFiles(p, True)
    n = size = 0
    while it.hasNext():
        st = it.next()
        if st.getPath().getName().endswith(".parquet"):
            n += 1
            size += st.getLen()
    return n, size


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    reps = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    spark = build_session()
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = ev.count()
    big = (ev.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
           .select((F.col("event_id") + F.col("r") * n).cast("string").alias("event_key"),
                   (F.col("ts") + F.make_dt_interval(F.col("r").cast("int") * 2))
                   .alias("received"), "user_id", "event_type", "value"))
    big = big.withColumn("event_date", F.date_format("received", "yyyy-MM-dd"))
    src = fresh_dir(spark, "probe_src")
    big.repartition(32).write.parquet(src)
    big = spark.read.parquet(src)
    last_two = [r[0] for r in big.select("event_date").distinct()
                .orderBy(F.desc("event_date")).limit(2).collect()]
    batch = (big.filter(F.col("event_date").isin(last_two))
             .withColumn("value", F.col("value") + 1))

    part = PartitionedTable(spark, fresh_dir(spark, "probe_part"), "event_date")
    snap = SnapshotTable(spark, fresh_dir(spark, "probe_snap"))
    part.write(big)
    snap.write(big)
    files_before = {"partitioned": count_files(spark, part.path),
                    "snapshot": count_files(spark, snap.path)}
    out = {"rows": big.count(), "dates": big.select("event_date").distinct().count(),
           "batch_rows": batch.count(), "batch_dates": last_two}
    for name, table in (("partitioned", part), ("snapshot", snap)):
        t0 = time.perf_counter()
        table.upsert(batch, ["event_key"])
        out[f"{name}_sec"] = round(time.perf_counter() - t0, 2)
        files, size = count_files(spark, table.path)
        out[f"{name}_files_written"] = files - files_before[name][0]
        out[f"{name}_bytes_written"] = size - files_before[name][1]
    assert part.read().count() == snap.read().count() == out["rows"]
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
