"""Tables that only grow: ledgers of what a job has read, and quarantines.

A ledger decides what is unread by anti-join. It compares items whole and never by
order, so unlike a time mark it cannot pass over an item that shows up late or with
an earlier time. Items are added after the work on them is written: a crash in
between means that they are read again, which the idempotent upserts allow.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import path_exists, read_text, write_text

# The two kinds of ledger items.
FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()),
                      T.StructField("modified", T.TimestampType())])
LOADS = T.StructType([T.StructField("load_id", T.StringType()), T.StructField("part", T.StringType())])


class AppendTable:
    """Parquet files under one folder; every :meth:`append` adds some, none is rewritten."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/_schema.json")

    def read(self) -> DataFrame:
        text = read_text(self.spark, f"{self.path}/_schema.json")
        if text is None:
            if self.schema is None:
                raise FileNotFoundError(f"nothing was appended to {self.path}")
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(text))).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        if self.schema is not None:
            rows = rows.select(*self.schema.fieldNames())
        rows.hint("rebalance").write.mode("append").parquet(self.path)
        write_text(self.spark, f"{self.path}/_schema.json", rows.schema.json())

    def unread(self, items: DataFrame, on: Sequence[str]) -> DataFrame:
        """The items that the table does not hold."""
        return items.join(self.read().select(*on), list(on), "left_anti") if self.exists() else items

    def expire(self, keep: int = 2) -> list:
        """Nothing to remove: no version is ever replaced."""
        return []
