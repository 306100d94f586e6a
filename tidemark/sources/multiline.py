"""Multi-line JSON files read by several tasks each.

Spark's whole-file readers give a pretty-printed file to one task. Here a file is read as
lines, so it is split by size like any text. JSON strings hold no line breaks, so a line
always begins outside a string, and the bracket depth at a line is a prefix sum: running
sums inside a split, plus what the splits before it add up to. The text is read three times, once
for either sum by split and once for the records; of the sums, one row a split is kept. Records are cut where the
depth is back at that of the top level; one that goes on over a split is put together again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import sized_broadcast
from tidemark.operators.upsert import materialize

STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'     # possessive: long strings need no deep stack
CUT = "\x01"             # no JSON text holds this character


def _segments(value: Column) -> Column:
    """A line in pieces none of which holds the end of one element and the begin of the next.
    Lines that may hold such a place are cut after each string, each comma and between
    brackets; most lines of pretty-printed files hold none."""
    place = r",\s*\S|[}\]]\s*[{\[]"
    inside = value.rlike(place) & F.regexp_replace(value, STRING, '""').rlike(place)
    cut = F.regexp_replace(value, rf"({STRING})|(,)|([}}\]])(?=\s*[{{\[])", f"$1$2$3{CUT}")
    return F.when(inside, F.split(cut, CUT)).otherwise(F.array(value))


def _delta(segment: Column) -> Column:
    """Brackets that a piece opens, less those that it closes, outside strings."""
    bare = F.regexp_replace(segment, STRING, "")
    sum_ = F.regexp_count(bare, F.lit(r"[\[{]")) - F.regexp_count(bare, F.lit(r"[\]}]"))
    return F.when(segment.rlike(r"[\[\]{}]"), sum_).otherwise(F.lit(0))


def _by_split(totals: DataFrame, file: str, what: str, out: str, *keep: Column) -> DataFrame:
    """One row a split, computed once: ``out`` is the sum of ``what`` over the splits of the
    file before it."""
    before = Window.partitionBy(file).orderBy("_split")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    return materialize(totals.select(file, "_split", *keep, F.coalesce(
        F.sum(what).over(earlier), F.lit(0)).alias(out)))


def read_multiline(spark: SparkSession, paths: str | Sequence[str], base: str, schema,
                   partition_columns: Sequence[str] = ()) -> DataFrame:
    """One row a record: ``value`` (its text), ``source_file`` and the folder columns.

    Files hold one array, whose elements are the records, or objects one after another.
    ``schema`` is that of the lines (:func:`tidemark.sources.files.text_schema`). Blank
    files hold no records. In a file whose brackets do not match, the records before the
    place are as they were; what follows it is text that does not parse. A file without line
    breaks is one line, so one task.
    """
    lines = spark.read.schema(schema).option("basePath", base).text(paths)
    lines = lines.where(F.col("value").rlike(r"\S")).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"), "value", *partition_columns)
    rows = lines.select("source_file", "_split", "_line", *partition_columns,
                        F.posexplode(_segments(F.col("value"))).alias("_pos", "_text"))
    rows = rows.withColumn("_delta", _delta(F.col("_text")))
    order = F.struct("_line", "_pos")
    # a file is an array if its first line opens one: the first line of its first split. Files
    # get a number, so that no line is shuffled with its path.
    file = Window.partitionBy("source_file").orderBy("_split").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    totals = rows.groupBy("source_file", "_split").agg(
        F.sum("_delta").alias("_d"), F.min_by("_text", order).alias("_head"),
        F.min(order).alias("_first"), *[F.first(c).alias(c) for c in partition_columns])
    outer = _by_split(
        totals.withColumn("_at", F.monotonically_increasing_id()), "source_file", "_d", "_outer",
        F.first("_at").over(file).alias("_file"), *partition_columns,
        F.first("_head").over(file).rlike(r"^\s*\[").alias("_in_array"),
        F.first("_split").over(file).alias("_start"),
        F.when(F.first("_split").over(file) == F.col("_split"), F.col("_first")).alias("_first"))
    files = outer.where(F.col("_split") == F.col("_start")).select("_file", "source_file", *partition_columns)
    here = ["_file", "_split"]
    opens = F.col("_in_array") & F.coalesce(order == F.col("_first"), F.lit(False))
    text = F.when(opens, F.regexp_replace("_text", r"^\s*\[", "")).otherwise(F.col("_text"))
    rows = (rows.drop(*partition_columns)
            .join(sized_broadcast(outer.drop("_start", *partition_columns)), ["source_file", "_split"])
            .select(*here, "_line", "_pos", "_delta", "_outer", "_in_array", text.alias("_text")))
    so_far = Window.partitionBy(*here).orderBy("_line", "_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_depth", F.sum("_delta").over(so_far) + F.col("_outer"))
    rows = rows.withColumn("_ends", (F.col("_depth") <= F.col("_in_array").cast("int")).cast("int"))
    closes = F.col("_in_array") & (F.col("_depth") <= 0)
    text = F.when(closes, F.regexp_replace("_text", r"\]\s*$", "")).otherwise(F.col("_text"))
    # records are numbered by the ends before them
    ended = _by_split(rows.groupBy(*here).agg(F.sum("_ends").alias("_n")), "_file", "_n", "_earlier")
    rows = rows.withColumn("_text", text).withColumn(
        "_record", F.sum("_ends").over(so_far) - F.col("_ends"))
    rows = rows.join(sized_broadcast(ended), here).withColumn(
        "_record", F.col("_record") + F.col("_earlier"))
    parts = F.sort_array(F.collect_list(F.struct("_split", "_line", "_pos", "_text")))
    joined = rows.groupBy("_file", "_record", "_in_array").agg(
        F.array_join(F.transform(parts, lambda p: p["_text"]), "\n").alias("value"))
    bare = F.regexp_replace("value", r"^[\s,]+|[\s,]+$", "")
    value = F.when(F.col("_in_array"), bare).otherwise(F.trim("value"))
    return joined.join(sized_broadcast(files), "_file").select(
        value.alias("value"), *partition_columns, "source_file").where(F.col("value").rlike(r"\S"))
