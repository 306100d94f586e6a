"""Distinct visitors that are kept up, so a report need not read the fact.

Two forms, both merged over any set of parts:

* sketches: one HyperLogLog sketch a date and key. A range of dates is a union of
  sketches; the estimate is within a few percent (2.6 % / sqrt(k) grows with fewer bits).
* bitmaps: visitors get dense numbers once; one bitmap a key and block of 32768 numbers.
  Counts are exact, and adding the same events again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.upsert import materialize

LOG_K = 12               # 4096 registers: a standard error of 1.6 %


# --- sketches ----------------------------------------------------------------------

def visitor_sketches(fact: DataFrame, date_col: str, keys: Sequence[str],
                     visitor_col: str = "visitor_id") -> DataFrame:
    """(date, keys, sketch, events): one row a date and key, partly aggregated before the shuffle."""
    return fact.groupBy(date_col, *keys).agg(
        F.hll_sketch_agg(visitor_col, F.lit(LOG_K)).alias("sketch"),
        F.count(F.lit(1)).alias("events"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], out: str = "unique_visitors") -> DataFrame:
    """Estimated distinct visitors a key over all rows of ``sketches``; without keys over everything."""
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"),
                                         F.sum("events").alias("events"))
    return merged.select(*keys, F.hll_sketch_estimate("sketch").alias(out), "events")


# --- bitmaps -----------------------------------------------------------------------

def number_new(known: DataFrame | None, found: DataFrame, col: str) -> DataFrame:
    """(col, number) of the values in ``found`` that ``known`` lacks, numbered on from its
    largest number without gaps. Tasks number their own rows; only one count a task is added
    up. NULL gets no number."""
    fresh = found.select(col).where(F.col(col).isNotNull()).distinct()
    start = 0
    if known is not None:
        fresh = fresh.join(known.select(col), col, "left_anti")
        start = known.agg(F.max("number")).first()[0] or 0
    # high bits of the id: the task; low bits: 0, 1, 2, ... in it
    marked = materialize(fresh.withColumn("_id", F.monotonically_increasing_id()))
    task = F.shiftright("_id", 33)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (marked.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
               .select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    low = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (marked.withColumn("_task", task).join(F.broadcast(offsets), "_task")
            .select(col, (low + F.col("_before") + F.lit(start + 1)).alias("number")))


def visitor_bitmaps(events: DataFrame, numbers: DataFrame, keys: Sequence[str],
                    visitor_col: str = "visitor_id") -> DataFrame:
    """(keys, block, bits) of the visitors of ``events``; each has its number in ``numbers``.
    A key's blocks are spread over the shuffle, so a hot key does not meet in one task."""
    pairs = events.select(*keys, visitor_col).where(F.col(visitor_col).isNotNull()).distinct()
    placed = pairs.join(numbers, visitor_col)
    return placed.groupBy(*keys, F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merge_bitmaps(old: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    both = new if old is None else old.unionByName(new)
    return both.groupBy(*keys, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], out: str = "unique_visitors") -> DataFrame:
    """Exact distinct visitors a key."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out))


def count_all(bitmaps: DataFrame, out: str = "unique_visitors") -> DataFrame:
    """Exact distinct visitors over all keys: blocks are united first."""
    united = bitmaps.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(out))
