"""Process only unseen input, idempotently by key.

The file source's checkpoint remembers which files were processed, which
is what the hand-kept "last run" marks do for the batch jobs. Each
micro-batch is deduplicated per key and upserted into a snapshot table;
a replayed micro-batch (after a failure) upserts the same rows again,
which changes nothing for non-NULL keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.dedup import latest_per_key
from tidemark.operators.upsert import materialize
from tidemark.sources.partitioned import PartitionedTable
from tidemark.sources.snapshots import SnapshotTable


def upsert_stream(stream: DataFrame, table: SnapshotTable | PartitionedTable, keys: Sequence[str],
                  order: Sequence[Column], checkpoint: str,
                  prepare: Callable[[DataFrame, int], DataFrame] | None = None,
                  newer_than: str | None = None, wait: bool = True) -> StreamingQuery:
    """Run ``stream`` to the end of the available input (``availableNow``).

    ``prepare(batch, epoch)`` shapes each micro-batch (flatten, stamp) before
    the per-key dedup by ``order``; ``newer_than`` keeps an old file from
    overwriting a newer row (late data), see :func:`tidemark.operators.upsert.upsert`.
    """
    def each(batch: DataFrame, epoch: int) -> None:
        # Read once, however many passes prepare/upsert make, into shared storage.
        batch = materialize(batch)
        b = prepare(batch, epoch) if prepare else batch
        table.upsert(latest_per_key(b, keys, order), keys, newer_than=newer_than)

    q = (stream.writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
    return q
