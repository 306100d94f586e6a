"""Places of rows in the order of their group, without one task for one group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.textkit import tidied
from tidemark.session import work_dir


def places(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``at`` (0, 1, ... in each group, ascending by ``order``) and ``n``, the
    group's rows. ``group`` is text and never null.

    Rows are dealt by sampled splitters over group and order, so a group goes on over many
    ranges. Each sorted range numbers its own rows of a group; the counts of the ranges,
    one row a range and group, add up to the place where the next one begins.
    """
    work_dir(rows.sparkSession)
    ranges = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    out = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()),
                        T.StructField("at", T.LongType())])

    @tidied
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(group)
            codes = names.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(np.diff(codes, prepend=-1))
            at = np.arange(len(codes)) - np.repeat(heads, np.diff(np.append(heads, len(codes))))
            first = heads[1] if len(heads) > 1 else len(codes)
            if names[0].as_py() == last:
                at[:first] += seen
            last, seen = names[len(names) - 1].as_py(), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(codes), part, np.int32)), pa.array(at)],
                names=[*batch.schema.names, "part", "at"])

    numbered = ranges.mapInArrow(number, out).checkpoint()
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy(group, "part").agg(F.count("*").alias("rows"))
               .select(group, "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
                       F.sum("rows").over(Window.partitionBy(group)).alias("n")))
    placed = numbered.join(offsets, [group, "part"])
    return placed.withColumn("at", F.col("at") + F.col("before")).drop("part", "before")
