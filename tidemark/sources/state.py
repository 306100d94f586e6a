"""High-water-mark state (S7 read, K6 write).

Each mark name is its own one-row snapshot table (``<root>/<name>/``) with a
real ``TIMESTAMP_NTZ`` (UTC): jobs that run at the same time and own
different marks never rewrite each other's state, and a save needs no read.
A mark is saved only after the data it covers is written, and never as NULL.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import to_utc_naive
from tidemark.schemas import WATERMARKS
from tidemark.sources.files import list_children
from tidemark.sources.snapshots import SnapshotTable

_NAME = re.compile(r"^[A-Za-z0-9_.-]+$")


class WatermarkStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _table(self, name: str) -> SnapshotTable:
        if not _NAME.match(name):
            raise ValueError(f"bad mark name {name!r}")
        return SnapshotTable(self.spark, f"{self.path}/{name}")

    def _read(self, table: SnapshotTable) -> DataFrame:
        # Explicit schema: no schema-inference job for a one-row table.
        return self.spark.read.schema(WATERMARKS).parquet(table.snapshot_path(table.latest()))

    def get(self, name: str, default: dt.datetime | str) -> dt.datetime:
        """Saved mark for ``name``, or ``default`` when none was saved."""
        t = self._table(name)
        if t.exists():
            row = self._read(t).agg(F.max("watermark").alias("m")).first()
            if row is not None and row["m"] is not None:
                return row["m"]
        return to_utc_naive(default)

    def save(self, name: str, mark: dt.datetime | str | None) -> bool:
        """Save ``mark`` for ``name``; a None mark is refused (returns False)."""
        if mark is None:
            return False
        row = self.spark.createDataFrame([(name, to_utc_naive(mark))], WATERMARKS)
        self._table(name).write(row.coalesce(1))
        return True

    def expire(self, keep: int = 2) -> dict[str, list[int]]:
        """Delete all but the newest ``keep`` saves of each mark."""
        return {n: self._table(n).expire(keep) for n in self.names()}

    def names(self) -> list[str]:
        return sorted(n for n in list_children(self.spark, self.path)
                      if _NAME.match(n) and self._table(n).exists())

    def all(self) -> DataFrame:
        """All saved marks, one row per name."""
        frames = [self._read(self._table(n)) for n in self.names()]
        if not frames:
            return self.spark.createDataFrame([], WATERMARKS)
        return reduce(DataFrame.unionByName, frames)
