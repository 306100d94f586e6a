"""Keyed tables as immutable snapshots.

A table is a folder of ``snapshot-NNNNNNNN`` sub-folders. A write never
touches an existing snapshot: it writes the next one, and a snapshot counts
only once Spark's commit has written its ``_SUCCESS`` marker. So

* a job may read a table and write its merged version in one plan (the
  same-path overwrite of a Parquet table would delete its own input);
* a job that dies mid-write leaves an uncommitted folder that readers skip;
* re-running a job after a failure is safe.

One writer per table (each layer job owns its tables): the next version is
picked when writing, so a crashed attempt never blocks the next one, but two
concurrent writers of the same table could lose an update. For tables with
concurrent writers use :class:`tidemark.sources.partitioned.PartitionedTable`,
whose manifest commits are optimistic (a stale writer fails).

Each snapshot also carries its schema in ``_schema.json`` (ignored by
Parquet readers), so reading it back needs no schema-inference job.
Old snapshots stay until removed by :meth:`SnapshotTable.expire`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.joins import fits_in_broadcast
from tidemark.operators.upsert import newer_rows, staged, upsert as merge_frames
from pyspark.sql import types as T

from tidemark.sources.files import delete_path, list_children, path_exists, read_text, write_text

_SNAP = re.compile(r"^snapshot-(\d{8})$")


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _versions(self) -> list[int]:
        return sorted(int(m.group(1)) for n in list_children(self.spark, self.path)
                      if (m := _SNAP.match(n)))

    def snapshot_path(self, version: int) -> str:
        return f"{self.path}/snapshot-{version:08d}"

    def committed(self) -> list[int]:
        return [v for v in self._versions()
                if path_exists(self.spark, f"{self.snapshot_path(v)}/_SUCCESS")]

    def exists(self) -> bool:
        return bool(self.committed())

    def latest(self) -> int | None:
        c = self.committed()
        return c[-1] if c else None

    def read(self, version: int | None = None) -> DataFrame:
        v = self.latest() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed snapshot in {self.path}")
        path = self.snapshot_path(v)
        text = read_text(self.spark, f"{path}/_schema.json")
        reader = self.spark.read
        if text:
            reader = reader.schema(T.StructType.fromJson(json.loads(text)))
        return reader.parquet(path)

    def write(self, df: DataFrame) -> int:
        """Write ``df`` as the next snapshot; returns its version."""
        versions = self._versions()
        v = (versions[-1] + 1) if versions else 1
        path = self.snapshot_path(v)
        df.write.mode("errorifexists").parquet(path)
        write_text(self.spark, f"{path}/_schema.json", df.schema.json())
        return v

    def expire(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` committed snapshots (and any
        uncommitted folder older than them). Run it between jobs: a reader
        still scanning an old snapshot would lose its files."""
        committed = self.committed()
        if len(committed) <= keep:
            return []
        oldest_kept = committed[-keep]
        gone = [v for v in self._versions() if v < oldest_kept]
        for v in gone:
            delete_path(self.spark, self.snapshot_path(v))
        return gone

    def upsert(self, batch: DataFrame, keys: Sequence[str], newer_than: str | None = None,
               broadcast: bool | None = None) -> int:
        """Create the table from ``batch``, or write ``latest MERGE batch``.
        With ``newer_than``, a batch with no winning row writes nothing."""
        if not self.exists():
            return self.write(batch)
        with staged(batch) as rows:
            return self._apply(rows, keys, newer_than, broadcast)

    def _apply(self, batch: DataFrame, keys: Sequence[str], newer_than: str | None,
               broadcast: bool | None) -> int:
        target = self.read()
        if broadcast is None:
            broadcast = fits_in_broadcast(batch.select(*keys))
        if newer_than is not None:
            batch = newer_rows(target, batch, keys, newer_than, broadcast)
            if batch.isEmpty():
                return self.latest()
        return self.write(merge_frames(target, batch, keys, broadcast=broadcast,
                                       checkpoint=False))
