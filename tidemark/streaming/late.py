"""Event-time streams: keep each key once, and tell late records apart.

A record is late when its time lies before the watermark: the newest time of the earlier
micro-batches less a delay. Late records go to a side table, so kept and late records
are all records. A key is kept once within the watermark: the kept rows that the
watermark has not passed are the state, read by date; older ones are never looked at
again, which bounds the state as the watermark moves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.time import mark_literal
from tidemark.operators.dedup import distinct_on, oldest_first
from tidemark.operators.upsert import materialize
from tidemark.sources.append import AppendTable
from tidemark.sources.partitioned import PartitionedTable

EPOCHS = T.StructType([T.StructField("epoch", T.LongType()), T.StructField("newest", T.TimestampNTZType())])


def keep_in_time(stream: DataFrame, key: str, time_col: str, delay: dt.timedelta,
                 kept: PartitionedTable, late: AppendTable, checkpoint: str,
                 wait: bool = True) -> StreamingQuery:
    """Run ``stream`` to the end of the available input. New keys go to ``kept`` (partitioned
    by date of ``time_col``, which must be TIMESTAMP_NTZ), late records and those without a
    time to ``late``, with the epoch and the watermark that they missed.

    The newest time of each micro-batch is written before its rows; the watermark of an epoch
    comes from earlier epochs only, so an epoch that is run again decides as before. Of
    several records with one key in a micro-batch the earliest stays.
    """
    spark = stream.sparkSession
    epochs = AppendTable(spark, f"{checkpoint}-epochs", EPOCHS)

    def each(batch: DataFrame, epoch: int) -> None:
        batch = materialize(batch)
        before = epochs.read().where(F.col("epoch") < epoch).agg(F.max("newest")).first()[0]
        newest = batch.agg(F.lit(epoch).cast("long").alias("epoch"), F.max(time_col).alias("newest"))
        epochs.append(epochs.unread(newest, ["epoch"]))
        watermark = before - delay if before is not None else None
        in_time = F.col(time_col).isNotNull()
        if watermark is not None:
            in_time = in_time & (F.col(time_col) >= mark_literal(watermark))
        missed = batch.where(~in_time).withColumn("epoch", F.lit(epoch).cast("long")).withColumn(
            "watermark", mark_literal(watermark) if watermark else F.lit(None).cast("timestamp_ntz"))
        if not (late.exists() and late.read().where(F.col("epoch") == epoch).take(1)):
            late.append(missed)
        fresh = distinct_on(batch.where(in_time), [key], oldest_first(time_col))
        fresh = fresh.withColumn(kept.col, F.date_format(time_col, "yyyy-MM-dd"))
        if kept.exists():
            known = kept.read()
            if watermark is not None:       # the state: pruned to the dates that still count
                known = known.where((F.col(kept.col) >= f"{watermark:%Y-%m-%d}")
                                    & (F.col(time_col) >= mark_literal(watermark)))
            fresh = fresh.join(known.select(key), key, "left_anti")
        kept.upsert(fresh, [key])

    q = (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q
