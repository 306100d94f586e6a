"""Ingestion stamp and source lineage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import mark_literal


def stamp(df: DataFrame, now: dt.datetime | str | None = None,
          time_col: str = "ingestion_time", file_col: str = "source_file",
          base_name: bool = False) -> DataFrame:
    """Add the ingestion time and the file each row came from.

    ``now`` is taken once on the driver and written as a literal, so a task
    re-run after a lost executor stamps the same value (``current_timestamp``
    would be re-evaluated by a later job over the same lineage).
    The file comes from the scan's hidden ``_metadata`` column: the full path,
    or only the base name. A ``file_col`` already present is kept (streams
    take it before ``foreachBatch``, where the scan columns are gone).
    """
    now = now or dt.datetime.now(dt.timezone.utc)
    out = df.withColumn(time_col, mark_literal(now))
    if file_col in df.columns:
        return out
    return out.withColumn(file_col, source_file(base_name))


def source_file(base_name: bool = False) -> F.Column:
    """Path (or base name) of the file a scanned row came from."""
    return F.col("_metadata.file_name") if base_name else F.col("_metadata.file_path")
