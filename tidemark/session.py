"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job needs to be correct (UTC) or to plan well at any scale (AQE).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # upserts checkpoint their batch; delete those files once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def _default_driver_memory() -> str:
    """60% of physical memory, at most 16g (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(16, int(total * 0.6 / 2**30)))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, use the cluster's
    own session and call :func:`configure` on it."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory",
                       os.environ.get("TIDEMARK_DRIVER_MEMORY") or _default_driver_memory())
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the library assumes (UTC wall clock)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for tables a job writes for itself.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only when
    that is unset (local runs, tests) does it pick a fresh local folder and
    register it as the checkpoint dir, so ``DataFrame.checkpoint`` works too.
    On a cluster without that setting it raises: a machine-local folder would
    be out of the other machines' reach.
    """
    jd = spark.sparkContext._jsc.sc().getCheckpointDir()
    registered = jd.get() if jd.isDefined() else None
    d = spark.conf.get("spark.checkpoint.dir", None) or registered
    if not d and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="tidemark-work-")
    if not registered:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused sub-folder of :func:`work_dir` (never reused, never cleared)."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
