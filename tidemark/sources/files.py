"""File readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.variant import misfit
from tidemark.schemas import with_partition

CORRUPT_COLUMN = "_corrupt_record"
RECORD_COLUMN = "record"


def read_json(spark: SparkSession, path: str, schema: T.StructType,
              multi_line: bool = True, partition_columns: tuple[str, ...] = (),
              keep_corrupt: bool = False) -> DataFrame:
    """JSON files under ``path`` with an explicit schema.

    ``multi_line=True`` reads pretty-printed files (one object, or an array
    of objects that becomes one row each); such files are not splittable, so
    land large inputs as JSON lines (``multi_line=False``) instead.
    ``partition_columns`` are ``name=value`` directories, typed as declared
    (text), never inferred. ``keep_corrupt`` adds ``_corrupt_record`` for
    rows that do not parse (PERMISSIVE mode) so they can be quarantined.
    """
    schema = with_partition(schema, *partition_columns)
    if keep_corrupt:
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    reader = (spark.read.schema(schema)
              .option("multiLine", multi_line)
              .option("mode", "PERMISSIVE"))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.json(path)


def text_schema(partition_columns: tuple[str, ...] = ()) -> T.StructType:
    """Schema of raw files read as text: a record (or file) a row, and the folder values."""
    return with_partition(T.StructType([T.StructField("value", T.StringType())]), *partition_columns)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of every file under ``path``. Their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def read_text_records(spark: SparkSession, path: str, multi_line: bool,
                      partition_columns: tuple[str, ...] = (),
                      files: Sequence[str] | None = None) -> DataFrame:
    """Raw JSON files as text, with ``source_file``; see :func:`parse_records`. ``files``
    are the paths below ``path`` to read (all if not given). Multi-line files are split
    too (:func:`tidemark.sources.multiline.read_multiline`)."""
    paths = path if files is None else list(files)
    if multi_line:
        from tidemark.sources.multiline import read_multiline
        return read_multiline(spark, paths, path, text_schema(partition_columns), partition_columns)
    lines = spark.read.schema(text_schema(partition_columns)).option("basePath", path).text(paths)
    return lines.withColumn("source_file", F.col("_metadata.file_path"))


def parse_records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of JSON text (column ``value``), parsed once into a VARIANT.

    Column ``record`` is the whole record, with the fields outside the schema too; the
    declared fields are taken from it. ``_corrupt_record`` is the record's text if it is
    no JSON object, or if a declared field has a value that does not convert to the
    declared type (a number given as text does). A field given twice is not JSON here.
    An array of records gives one row each. Folder columns take the place of fields of
    their name. Blank lines are no records.
    """
    others = [c for c in lines.columns if c != "value"]
    whole = (lines.where(F.col("value").rlike(r"\S"))
             .select(*others, "value", F.try_parse_json("value").alias("_whole"),
                     F.col("value").rlike(r"^\s*\[").alias("_many")))
    items = F.try_variant_get("_whole", "$", "array<variant>")
    listed = F.col("_many") & items.isNotNull()
    rows = whole.select(*others, F.when(~listed, F.col("value")).alias("_line"),
                        F.explode(F.when(listed, items).otherwise(F.array("_whole"))).alias(RECORD_COLUMN))
    kind = T.StructType([f for f in schema.fields if f.name not in others])
    bad, empty = F.lit(False), F.lit(True)
    if kind.fields:
        rows = rows.withColumn("_p", F.try_variant_get(RECORD_COLUMN, "$", kind.simpleString()))
    for f in kind.fields:
        bad = bad | misfit(F.col(RECORD_COLUMN), f.dataType, F.col(f"_p.{f.name}"), f"$.{f.name}")
        empty = empty & F.col(f"_p.{f.name}").isNull()
    other = empty & ~F.coalesce(F.schema_of_variant(RECORD_COLUMN).startswith("OBJECT"), F.lit(False))
    corrupt = F.when(F.col(RECORD_COLUMN).isNull() | bad | other,
                     F.coalesce("_line", F.to_json(RECORD_COLUMN)))
    return rows.select(*[F.col(f"_p.{f.name}").alias(f.name) for f in kind.fields], *others, RECORD_COLUMN, corrupt.alias(CORRUPT_COLUMN))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def hadoop_fs(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) for ``path`` - any scheme the cluster supports."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists (any Hadoop file system)."""
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (empty if absent)."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` (retention of old snapshots)."""
    fs, p = hadoop_fs(spark, path)
    return bool(fs.delete(p, True))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file (overwrites)."""
    fs, p = hadoop_fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file, or None when it does not exist."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    ins = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(ins, "UTF-8")
    finally:
        ins.close()
