"""Writers: overwrite, JSON landing, JSON samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_overwrite(df: DataFrame, path: str) -> None:
    """Full refresh of a Parquet table (K1). Never point it at a path the
    same plan reads: use :class:`tidemark.sources.snapshots.SnapshotTable`."""
    df.write.mode("overwrite").parquet(path)


def land_json(df: DataFrame, path: str, partition_by: Sequence[str] = (),
              drop: Sequence[str] = (), observe: tuple | None = None) -> None:
    """Append accepted raw records as JSON lines under ``name=value``
    folders (K5). Every run adds new files; nothing is rewritten. Rows are
    rebalanced by folder first, so files follow the data's size and not the
    number of tasks times folders. Files are compressed: a reader takes each whole, and
    their size is bounded by the rebalance. ``observe`` is an Observation and the aggregates
    that the write collects on its way; columns of ``drop`` are not written."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if observe:         # next to the write, so that an empty input is observed too
        df = df.observe(*observe)
    w = df.drop(*drop).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("compression", "gzip").json(path)


def write_json_sample(df: DataFrame, path: str, order: Sequence[str], n: int = 5,
                      drop: Sequence[str] = ()) -> None:
    """First ``n`` rows in key order as JSON (K4), without the columns of ``drop``."""
    df.orderBy(*order).limit(n).drop(*drop).write.mode("overwrite").json(path)
