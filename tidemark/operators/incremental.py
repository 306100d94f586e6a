"""Incremental selection: high-water marks, acceptance, allow lists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import key_present
from tidemark.functions.time import mark_literal, parse_iso

# Defaults used when no mark has been saved yet.
DEFAULT_INGEST_MARK = "2000-01-01T00:00:00Z"
DEFAULT_LAYER_MARK = "1900-01-01T00:00:00"


def _dtype(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def newer_than_mark(df: DataFrame, ts_col: str, mark: dt.datetime | str,
                    lateness: dt.timedelta | None = None) -> DataFrame:
    """Rows strictly newer than the mark (F1). Pushed to the Parquet scan.

    ``lateness`` re-reads a window before the mark (safe with an idempotent
    upsert) so records arriving late with an older time are not lost.
    """
    lit = mark_literal(mark, _dtype(df, ts_col))
    if lateness:
        lit = lit - F.expr(f"INTERVAL {int(lateness.total_seconds())} SECONDS")
    return df.filter(F.col(ts_col) > lit)


def accept_since(df: DataFrame, text_col: str, mark: dt.datetime | str,
                 key_col: str | None = None, parsed_col: str = "_event_time") -> DataFrame:
    """Event-time acceptance (F2, F3): the text timestamp parses and is after
    the mark, and (when given) the key is present. NULL or bad times are
    rejected, never fail the job. Adds the parsed time as ``parsed_col``."""
    out = df.withColumn(parsed_col, parse_iso(text_col))
    cond = F.col(parsed_col) > mark_literal(mark)
    if key_col is not None:
        cond = cond & key_present(key_col)
    return out.filter(cond)


def allow_list(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Only the listed entities."""
    return df.filter(F.col(col).isin(list(values)))


def advance(df: DataFrame, ts_col: str, previous: dt.datetime | str,
            group_cols: Iterable[str] = ()) -> DataFrame:
    """New mark per group: max accepted time floored at the previous mark
    (A3, A4), count accepted (A5). A group or table with nothing new keeps
    its mark: ``greatest`` skips the NULL max.

    Returns columns ``*group_cols, previous_mark, new_mark, accepted,
    has_new``. Without groups the result is always one row.
    """
    prev = mark_literal(previous, _dtype(df, ts_col))
    newer = F.col(ts_col) > prev
    aggs = [F.max(F.when(newer, F.col(ts_col))).alias("_max"),
            F.count(F.when(newer, F.lit(1))).alias("accepted")]
    group_cols = list(group_cols)
    agg = df.groupBy(*group_cols).agg(*aggs) if group_cols else df.agg(*aggs)
    return agg.select(*group_cols,
                      prev.alias("previous_mark"),
                      F.greatest(prev, F.col("_max")).alias("new_mark"),
                      F.col("accepted").cast("long").alias("accepted"),
                      (F.col("accepted") > 0).alias("has_new"))


def batch_stats(batch: DataFrame, ts_col: str) -> tuple[int, dt.datetime | None]:
    """(row count, max time) of a batch in one job - the non-empty guard
    and the mark to save afterwards come from the same pass."""
    row = batch.agg(F.count(F.lit(1)).alias("n"), F.max(ts_col).alias("m")).first()
    return int(row["n"]), row["m"]

