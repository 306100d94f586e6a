"""Run layer jobs from the command line (e.g. with ``spark-submit``).

    spark-submit -m tidemark.plans.cli --root s3a://bucket/lake bronze silver gold
    python -m tidemark.plans.cli --root /data/lake --raw-layout by_key --multi-line all

Steps run in the order given: ``bronze`` (raw files that its ledger lacks),
``bronze-stream`` (raw files that its stream has not seen), ``silver``, ``gold``,
``refine``, ``curate``, ``kpi``, ``counts`` (kept distinct visitors),
``schema-test``, ``expire`` (keep the newest snapshots), or ``all``
(bronze-stream through kpi).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from tidemark.plans import jobs
from tidemark.session import configure

# "all" loads bronze from the file stream; the batch "bronze" step has a ledger of its own.
ALL = ["bronze-stream", "silver", "gold", "refine", "curate", "kpi"]


def run(spark: SparkSession, lake: jobs.Lake, steps: list[str], keep: int = 2) -> dict:
    out = {}
    for step in steps:
        if step == "all":
            out.update(run(spark, lake, ALL, keep))
        elif step == "bronze":
            out["bronze"] = jobs.raw_to_bronze(lake)
        elif step == "bronze-stream":
            present = [e for e in jobs.ENTITIES if jobs.path_exists(spark, lake.raw(e.name))]
            jobs.run_parallel({e.name: (lambda e=e: jobs.raw_to_bronze_stream(lake, e))
                               for e in present})
            out["bronze-stream"] = sorted(e.name for e in present)
        elif step == "silver":
            out["silver"] = jobs.bronze_to_silver(lake)
        elif step == "gold":
            out["gold"] = jobs.silver_to_gold(lake)
        elif step == "refine":
            jobs.refine(lake)
            out["refine"] = "done"
        elif step == "curate":
            jobs.curate(lake)
            out["curate"] = "done"
        elif step == "kpi":
            jobs.build_kpis(lake)
            out["kpi"] = "done"
        elif step == "counts":
            out["counts"] = jobs.keep_visitor_counts(lake)
        elif step == "schema-test":
            out["schema-test"] = sorted(jobs.schema_test(lake))
        elif step == "expire":
            out["expire"] = {f"{layer}/{name}": lake.table(layer, name).expire(keep)
                             for layer, name in lake.tables()}
            out["expire"] |= {f"marks/{n}": gone for n, gone in lake.marks.expire(keep).items()}
        else:
            raise SystemExit(f"unknown step {step!r}")
    return out


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--root", required=True, help="lake root folder (any Hadoop file system)")
    ap.add_argument("--raw-layout", choices=sorted(jobs.RAW_PARTITIONS), default="landed")
    ap.add_argument("--multi-line", action="store_true", help="raw files are pretty-printed JSON")
    ap.add_argument("--keep", type=int, default=2, help="snapshots kept by 'expire'")
    ap.add_argument("--lateness-hours", type=float, default=0.0,
                    help="landing takes records of this window before its mark too")
    ap.add_argument("steps", nargs="+")
    args = ap.parse_args(argv)
    spark = configure(SparkSession.builder.appName("tidemark").getOrCreate())
    lateness = dt.timedelta(hours=args.lateness_hours) if args.lateness_hours else None
    lake = jobs.Lake(spark, args.root, raw_multi_line=args.multi_line, raw_layout=args.raw_layout,
                     lateness=lateness)
    print(json.dumps(run(spark, lake, args.steps, args.keep), default=str))


if __name__ == "__main__":
    main(sys.argv[1:])
