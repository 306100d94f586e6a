"""Skew probe: replicate the events table R times (derived from the given
table, keys shifted), put a third of all rows on ONE visitor and ONE media,
then time the skew-sensitive operators and report, per stage, the longest
task against the median task (from Spark's event log in a scratch folder).

    python scripts/scale_probe.py [sf_dir] [R]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import kpi  # noqa: E402
from tidemark.operators.dedup import latest_per_key, newest_first  # noqa: E402
from tidemark.operators.upsert import upsert  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    reps = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    scratch = tempfile.mkdtemp(prefix="tidemark-probe-")
    logs = f"{scratch}/eventlog"
    os.makedirs(logs)
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                                 "spark.eventLog.rolling.enabled": "false",
                                 "spark.eventLog.compress": "false",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"})
    sc = spark.sparkContext
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = ev.count()
    big = (ev.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
           .select((F.col("event_id") + F.col("r") * n).alias("event_id"),
                   (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("r").cast("int")))
                   .alias("ts"),
                   F.when((F.col("event_id") + F.col("r")) % 3 == 0, F.lit(0))
                    .otherwise(F.col("user_id") + F.col("r") * 100000).cast("string").alias("visitor_id"),
                   F.when((F.col("event_id") + F.col("r")) % 3 == 1, F.lit("hot"))
                    .otherwise(F.concat(F.lit("m"), F.get_json_object("props", "$.k"), F.lit("_"),
                                        F.col("r").cast("string"))).alias("media_id"),
                   "value"))
    path = f"{scratch}/events_x{reps}.parquet"
    big.repartition(32).write.parquet(path)   # even input splits: isolate key skew from scan skew
    big = spark.read.parquet(path)
    total = big.count()
    hot_v = big.filter("visitor_id = '0'").count()
    hot_m = big.filter("media_id = 'hot'").count()
    print(json.dumps({"rows": total, "hot_visitor_rows": hot_v, "hot_media_rows": hot_m}))

    target = big.withColumn("event_key", F.col("event_id").cast("string"))
    batch = target.filter(F.col("event_id") % 100 == 0).withColumn("value", F.col("value") + 1)
    probes = {
        "latest_per_visitor": lambda: latest_per_key(big, ["visitor_id"], newest_first("ts", "event_id")),
        "distinct_visitors_by_media": lambda: kpi.distinct_visitors(big, ["media_id"]),
        "upsert_broadcast_check": lambda: upsert(target, batch, ["event_key"]),
        "upsert_sort_merge": lambda: upsert(target, batch, ["event_key"], broadcast=False),
    }
    results = {}
    for name, build in probes.items():
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        results[name] = {"sec": round(time.perf_counter() - t0, 2),
                         "jobs": sorted(sc.statusTracker().getJobIdsForGroup(name))}
    spark.stop()

    # Task durations per stage from the event log.
    job_stages, stage_tasks, stage_names, stage_recs = {}, {}, {}, {}
    for f in glob.glob(f"{logs}/**/*", recursive=True):
        if os.path.isdir(f):
            continue
        with open(f) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    job_stages[e["Job ID"]] = e["Stage IDs"]
                elif e["Event"] == "SparkListenerStageSubmitted":
                    stage_names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:60]
                elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Info"):
                    ti = e["Task Info"]
                    stage_tasks.setdefault(e["Stage ID"], []).append(
                        ti["Finish Time"] - ti["Launch Time"])
                    m = e.get("Task Metrics") or {}
                    recs = (m.get("Input Metrics", {}).get("Records Read", 0)
                            + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
                    stage_recs.setdefault(e["Stage ID"], []).append(recs)
    for name, r in results.items():
        worst = []
        for j in r.pop("jobs"):
            for s in job_stages.get(j, []):
                ts = stage_tasks.get(s)
                if ts:
                    rc = stage_recs.get(s, [0])
                    worst.append({"stage": s, "name": stage_names.get(s, ""), "tasks": len(ts),
                                  "max_ms": max(ts), "median_ms": statistics.median(ts),
                                  "max_records": max(rc), "median_records": statistics.median(rc)})
        worst.sort(key=lambda x: -x["max_ms"])
        r["slowest_stages"] = worst[:3]
    for name, r in results.items():
        print(name, r["sec"], "s")
        for w in r["slowest_stages"]:
            print("   ", json.dumps(w))


if __name__ == "__main__":
    main()
