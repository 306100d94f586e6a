"""Exact dedup by sorting content.

Rows are dealt by sampled splitters over the normalised text and sorted outside
memory, so that equal texts come to lie side by side; each text is then compared
in full with its neighbour. A splitter holds the text's first characters, its
digest and the id instead of the whole text: splitters stay small, and a group
of copies that holds a large share of all rows is cut by id into many ranges.
Only the first and last run of a range can go on in another one: those few are
added up by text, whatever the size of the groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.textkit import tidied
from tidemark.session import work_dir

LEAD = 32                # characters of a text in a splitter
KEEP = ("largest", "smallest")


def _mark(rows: pa.Table, heads: np.ndarray, sizes: np.ndarray, edge: int | None,
          only_first: bool) -> pa.Table:
    """Rows of whole runs that start at ``heads``; the first row of a run is its best.
    With ``only_first`` the other rows go, and only the runs' sizes tell of them."""
    if only_first:
        rows = rows.take(pa.array(heads))
        heads = np.arange(len(heads))
    n = rows.num_rows
    run = np.searchsorted(heads, np.arange(n), side="right") - 1
    first = np.zeros(n, bool)
    first[heads] = True
    shown = first if only_first or edge is not None else np.zeros(n, bool)
    text = rows["text"].take(pa.array(np.arange(n), mask=~shown))      # null where not shown
    return pa.table({
        "row": rows["row"], "id": rows["id"], "best": rows["id"].take(pa.array(heads[run])),
        "sha256": rows["sha256"], "text": text, "size": pa.array(sizes[run], pa.int64()),
        "first": pa.array(first), "edge": pa.array([edge] * n, pa.int64())})


def _runs(batches: Iterator[pa.RecordBatch], only_first: bool) -> Iterator[pa.Table]:
    """Runs of equal texts of one sorted range. The open run waits until it ends: its rows
    without their texts, or its first row alone. A range's edge runs are 2 p and 2 p + 1."""
    part = TaskContext.get().partitionId()
    held: list[pa.Table] = []
    last, size, closed = None, 0, 0

    def hold(rows: pa.Table, opens: bool) -> None:
        nonlocal size
        size += rows.num_rows
        if only_first:
            rows = rows.slice(0, 1 if opens else 0)
        if rows.num_rows:
            at = np.arange(rows.num_rows)
            text = rows["text"].take(pa.array(at, mask=(at > 0) | (not opens)))
            held.append(rows.set_column(rows.schema.get_field_index("text"), "text", text))

    def close(edge: int | None) -> pa.Table:
        nonlocal size
        out = _mark(pa.concat_tables(held), np.array([0]), np.array([size]), edge, only_first)
        held.clear()
        size = 0
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        rows, text = pa.Table.from_batches([batch]), batch.column("text")
        new = np.ones(len(text), bool)
        new[0] = last is None or text[0].as_py() != last
        if len(text) > 1:
            new[1:] = ~pc.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(new)
        if not len(heads):
            hold(rows, False)
            continue
        if last is not None:
            hold(rows.slice(0, heads[0]), False)
            yield close(None if closed else 2 * part)
            closed += 1
        at = 0
        if not closed and len(heads) > 1:              # the first run of the range
            hold(rows.slice(0, heads[1]), True)
            yield close(2 * part)
            closed, at = 1, 1
        if at < len(heads) - 1:                        # runs that begin and end in this batch
            lo, hi = heads[at], heads[-1]
            yield _mark(rows.slice(lo, hi - lo), heads[at:-1] - lo, np.diff(heads[at:]), None,
                        only_first)
        hold(rows.slice(heads[-1]), True)
        last = text[int(heads[-1])].as_py()
    if held:
        yield close(2 * part + 1 if closed else 2 * part)


def _grouped(docs: DataFrame, id_col: str, text_col: str,
             normalise: Callable[[Column], Column] | None, keep: str,
             columns: list[str], only_first: bool) -> DataFrame:
    if keep not in KEEP:
        raise ValueError(f"keep must be one of {KEEP}")
    work_dir(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    row = F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.struct(F.lit(0).alias("none"))
    keyed = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    keyed = keyed.withColumn("sha256", F.sha2("text", 256))
    order = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    spread = (F.substring("text", 1, LEAD), F.col("sha256"))
    ranges = keyed.repartitionByRange(*spread, order).sortWithinPartitions(*spread, "text", order)
    kinds = keyed.schema
    out = T.StructType([
        T.StructField("row", kinds["row"].dataType), T.StructField("id", kinds["id"].dataType),
        T.StructField("best", kinds["id"].dataType), T.StructField("sha256", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("size", T.LongType()),
        T.StructField("first", T.BooleanType()), T.StructField("edge", T.LongType())])

    @tidied
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, only_first):
            yield from rows.to_batches()

    marked = ranges.mapInArrow(mark, out).checkpoint()
    # Runs at the ends of ranges, two a range at most, are equal over ranges if their texts are.
    best = F.max("id") if keep == "largest" else F.min("id")
    whole = (marked.where("first AND edge IS NOT NULL").groupBy("text")
             .agg(F.sum("size").alias("all_size"), best.alias("all_best"),
                  F.collect_list("edge").alias("edges"))
             .select(F.explode("edges").alias("edge"), "all_size", "all_best"))
    joined = marked.join(F.broadcast(whole), "edge", "left")
    over = F.col("all_size").isNotNull()
    keep_id = F.when(over, F.col("all_best")).otherwise(F.col("best"))
    return joined.select(
        "row", "text", "id", keep_id.alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        (F.col("first") & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        F.col("sha256").alias("text_sha256"))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                normalise: Callable[[Column], Column] | None = None,
                keep: str = "largest") -> DataFrame:
    """Every row's group of equal texts: struct ``row`` (all columns but the text),
    keep_id, group_size, kept and text_sha256 (of the normalised text).

    Texts are equal when they are identical after ``normalise`` (none: as they are).
    A null text is empty. The row with the largest (or smallest) id of a group is
    kept; a null id loses to any other, and of repeated rows with one id and text
    exactly one is kept. Column names of ``docs`` cannot clash, as they stay inside
    ``row``. Rows of one text that share one id stay in one range.
    """
    columns = [c for c in docs.columns if c != text_col]
    return _grouped(docs, id_col, text_col, normalise, keep, columns, False).drop("text", "id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             normalise: Callable[[Column], Column] | None = None,
             keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they were, rules as
    for :func:`mark_copies`. Of each text, only one row a range is written."""
    return (_grouped(docs, id_col, text_col, normalise, keep, docs.columns, True)
            .where("kept").select("row.*"))
