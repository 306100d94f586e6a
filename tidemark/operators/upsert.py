"""Keyed upsert (merge: update all columns when matched, insert when not).

Expressed as ``target LEFT ANTI batch-keys UNION ALL batch``. Key equality
only: a NULL key never matches, so NULL-key target rows stay and NULL-key
batch rows are appended. The batch must hold one row per key (dedup it with
:func:`tidemark.operators.dedup.latest_per_key` first, as every layer job does).

Plan at scale:

* the batch is computed once and checkpointed to the shared checkpoint
  folder (it is read twice: keys for the anti join, rows for the union);
* when the batch keys are proven small they are broadcast, so the large
  target is only scanned and filtered, never shuffled; otherwise a
  sort-merge anti join (AQE splits a skewed target partition, e.g. many
  NULL keys).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import fits_in_broadcast
from tidemark.operators.keyfilter import holds_not, key_filter, might_hold
from tidemark.session import fresh_dir, work_dir
from tidemark.sources.files import delete_path


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder (survives lost
    executors, cuts the lineage)."""
    work_dir(df.sparkSession)   # ensures a checkpoint folder is set
    return df.checkpoint(eager=True)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed once into Parquet in the shared folder, which goes when the block ends.
    For wide rows that are read several times: they are stored compressed, and a pass over
    few columns reads only these. What the block makes of them must be written in it."""
    path = fresh_dir(df.sparkSession, "staged")
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_path(df.sparkSession, path)


def without(rows: DataFrame, gone: DataFrame, on: Sequence[str], broadcast: bool) -> DataFrame:
    """``rows`` whose ``on`` is none of ``gone``. If that is too large to broadcast, only the rows
    that may be hit are shuffled; the others are told by key bits in the scan."""
    on = list(on)
    if broadcast:
        return rows.join(F.broadcast(gone.select(*on)), on, "left_anti")
    bits = materialize(key_filter(gone, on))
    hit = might_hold(rows, bits, on).join(gone.select(*on).hint("merge"), on, "left_anti")
    return holds_not(rows, bits, on).unionByName(hit.select(*rows.columns))


def _align(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Batch with the target's column order (extra batch columns kept last)."""
    cols = [c for c in target.columns if c in batch.columns]
    cols += [c for c in batch.columns if c not in cols]
    return batch.select(*cols)


def _bc(df: DataFrame, on: bool) -> DataFrame:
    """Broadcast a proven-small side; otherwise pin a sort-merge join so
    Spark's file-size estimate cannot broadcast a side measured too large."""
    return F.broadcast(df) if on else df.hint("merge")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
           newer_than: str | None = None, broadcast: bool | None = None,
           checkpoint: bool = True) -> DataFrame:
    """Merged table: ``target`` with ``batch`` applied by ``keys``.

    ``newer_than``: name of an order column. When given, a batch row replaces
    a matched target row only if ``batch.c`` is not NULL and is greater than
    ``target.c`` or that is NULL; any other batch row is ignored, so a row
    without a time doesn't win again on every run. Unmatched batch rows are
    always inserted.

    ``broadcast``: True/False forces the join strategy; None (default) decides
    from a size check of the batch keys. ``checkpoint=False`` skips
    materializing the batch (when the caller already did).
    """
    keys = list(keys)
    batch = _align(batch, target)
    if checkpoint:
        batch = materialize(batch)
    if broadcast is None:
        broadcast = fits_in_broadcast(batch.select(*keys, *([newer_than] if newer_than else [])))
    if newer_than is not None:
        batch = newer_rows(target, batch, keys, newer_than, broadcast)
        if checkpoint:
            batch = materialize(batch)
    kept = without(target, batch, keys, broadcast)
    return kept.unionByName(batch, allowMissingColumns=True)


def order_wins(batch: Column, target: Column) -> Column:
    """Whether a batch row's order value replaces a matched target row's."""
    return batch.isNotNull() & (target.isNull() | F.coalesce(batch > target, F.lit(False)))


def newer_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str,
               broadcast: bool) -> DataFrame:
    """Batch rows that win against the target under ``newer_than``: new keys,
    ``batch.order > target.order``, or a batch order where the target's is NULL.
    Reads only the key and order columns of the target."""
    keys = list(keys)
    t_order = "__target_order"
    b = batch.select(*keys, F.col(order).alias("__batch_order"))
    t = target.select(*keys, F.col(order).alias(t_order))
    if not broadcast:       # only target rows whose key may be in the batch are shuffled
        t = might_hold(t, key_filter(b, keys), keys)
    wins = order_wins(F.col("__batch_order"), F.col(t_order))
    # Matched batch keys that lose: the target is streamed past the (small,
    # broadcast) batch keys; only the losing keys come back.
    losers = _bc(b, broadcast).join(t, on=keys, how="inner").filter(~wins).select(*keys)
    return without(batch, losers, keys, broadcast)
