"""Keyed table whose upsert rewrites only the partitions it touches.

Layout: ``<path>/<col>=<value>/part-*.parquet``, written by Spark's dynamic partition
overwrite, and ``<path>/_schema.json``. An upsert rewrites the partitions of the rows
that it adds and of those that it replaces, in whatever partition these lie; the others
are not copied. For append-mostly data partitioned by time (events), an incremental run
costs a narrow scan of the keys and O(touched partitions), not O(table).

Replaced rows are found by a join over key, partition and order columns. Batch keys are
broadcast behind a size check; a larger batch is turned into a bit set that is tested in
the scan (:mod:`tidemark.operators.keyfilter`), so only rows that may match are shuffled.

One writer a table at a time. Spark replaces the touched partitions one by one when the
job commits; if the driver dies in between, running the same upsert again completes it,
also where a key then stands in its old and its new partition.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import fits_in_broadcast
from tidemark.operators.keyfilter import key_filter, might_hold
from tidemark.operators.upsert import materialize, order_wins, staged, without
from tidemark.sources.files import delete_path, list_children, path_exists, read_text, write_text

SAFE = "^[A-Za-z0-9_.-]+$"      # values that are a folder name as they are


class PartitionedTable:
    def __init__(self, spark: SparkSession, path: str, partition_col: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.col = partition_col

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/_schema.json")

    def partitions(self) -> list[str]:
        return sorted(n.split("=", 1)[1] for n in list_children(self.spark, self.path)
                      if n.startswith(f"{self.col}="))

    def files(self) -> list[str]:
        """Paths of the data files, sorted; a partition that was not touched keeps its own."""
        return sorted(self.read().inputFiles())

    # --- read ----------------------------------------------------------------
    def read(self, partitions: Sequence[str] | None = None) -> DataFrame:
        text = read_text(self.spark, f"{self.path}/_schema.json")
        if text is None:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        schema = T.StructType.fromJson(json.loads(text)).add(self.col, T.StringType())
        if not self.partitions():
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.path)
        return rows if partitions is None else rows.where(F.col(self.col).isin(list(partitions)))

    # --- write ---------------------------------------------------------------
    def _values(self, df: DataFrame) -> set[str]:
        """Distinct partition values (bounded by the number of partitions)."""
        return {r[0] for r in df.select(self.col).distinct().collect()}

    def _checked(self, df: DataFrame) -> DataFrame:
        """The partition column as text; a value that is no safe folder name fails the job."""
        value = F.col(self.col).cast("string")
        message = F.concat(F.lit("partition value "), F.coalesce(value, F.lit("NULL")),
                           F.lit(f" of {self.col} must match {SAFE}"))
        good = F.coalesce(value.rlike(SAFE), F.lit(False))
        return df.withColumn(self.col, F.when(good, value).otherwise(F.raise_error(message)))

    def _overwrite(self, df: DataFrame) -> None:
        # REBALANCE by the partition column: AQE sizes the write tasks (splits a
        # huge date, merges small ones), so each partition gets few, large files.
        data = [c for c in df.columns if c != self.col]
        (df.select(*data, self.col).hint("rebalance", self.col)
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(self.col).parquet(self.path))
        schema = T.StructType([f for f in df.schema.fields if f.name != self.col])
        write_text(self.spark, f"{self.path}/_schema.json", schema.json())

    def write(self, df: DataFrame) -> None:
        """First load, or a full replacement of the partitions in ``df``, in one pass."""
        self._overwrite(self._checked(df))

    def upsert(self, batch: DataFrame, keys: Sequence[str], newer_than: str | None = None,
               broadcast: bool | None = None) -> None:
        """The table with ``batch`` applied by ``keys``, one row a key. With ``newer_than``, a
        batch row replaces a key's row only if its order value is greater, or the other is
        NULL; a batch without a winning row writes nothing. Rows with a NULL in their key
        never match, as in :func:`tidemark.operators.upsert.upsert`."""
        keys = list(keys)
        if not self.exists():
            return self.write(batch)
        with staged(self._checked(batch)) as rows:
            return self._apply(rows, keys, newer_than, broadcast)

    def _apply(self, batch: DataFrame, keys: list[str], newer_than: str | None,
               broadcast: bool | None) -> None:
        order = F.col(newer_than) if newer_than else F.lit(None).cast("int")
        wanted = batch.select(*keys, order.alias("__b"))
        if broadcast is None:
            broadcast = fits_in_broadcast(wanted)
        target = self.read()
        held = target.select(*keys, F.col(self.col).alias("__part"), order.alias("__t"))
        if broadcast:
            matched = held.join(F.broadcast(wanted), keys)
        else:
            matched = might_hold(held, key_filter(wanted, keys), keys).join(wanted.hint("merge"), keys)
        if newer_than is None:
            removed = matched.select(*keys, "__part").distinct()
        else:
            # A key has one row, unless an upsert broke off: then the best of them counts.
            matched = materialize(matched)
            here = F.struct("__t", "__part")
            best = matched.groupBy(*keys, "__b").agg(F.max(here).alias("__best"))
            wins = order_wins(F.col("__b"), F.col("__best.__t"))
            losers = best.where(~wins).select(*keys)
            batch = without(batch, losers, keys, broadcast)
            removed = (matched.drop("__b").join(self._side(best, broadcast), keys)
                       .where(wins | ~here.eqNullSafe(F.col("__best"))).select(*keys, "__part"))
        removed = materialize(removed)
        added = self._values(batch)
        cleared = {r[0] for r in removed.select("__part").distinct().collect()}
        if not added and not cleared:
            return None
        rows = self.read(sorted(added | cleared))
        gone = removed.withColumnRenamed("__part", self.col)
        kept = without(rows, gone, [*keys, self.col], broadcast)
        emptied = cleared - added
        if emptied:
            left = kept.where(F.col(self.col).isin(sorted(emptied)))
            emptied -= {r[0] for r in left.select(self.col).distinct().collect()}
        self._overwrite(kept.unionByName(batch, allowMissingColumns=True))
        self.drop(sorted(emptied))
        return None

    def drop(self, partitions: Sequence[str]) -> None:
        for value in partitions:
            delete_path(self.spark, f"{self.path}/{self.col}={value}")

    @staticmethod
    def _side(small: DataFrame, broadcast: bool) -> DataFrame:
        """Rows of batch keys only: as small as the batch, so its size check holds for them."""
        return F.broadcast(small) if broadcast else small.hint("merge")

    def expire(self, keep: int = 2) -> list[str]:
        """Nothing to remove: a partition's former files go when it is overwritten."""
        return []
