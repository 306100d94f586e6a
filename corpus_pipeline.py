"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's documents. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, quality, ship, simhash, substring_dedup
from tidemark.session import fresh_dir

KEEP_QUALITY = 0.7


def _with_chars(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text now is."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the labelled
    rows outside the held-out fold; with no such row it accepts all. The table
    ``labels`` has to be there."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2
    model = quality.fit(docs, labels, learn)
    return docs.where(quality.score(model, docs) >= KEEP_QUALITY)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    ship(spark)
    return simhash.keep_one(docs, shingle=3, distance=3)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; documents all stay."""
    ship(spark)
    return _with_chars(substring_dedup.remove_repeats(docs).select("row.*"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    ship(spark)
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and of the decoded text."""
    ship(spark)
    out = bpe.tokenized(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "source", "bpe.*")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("substring dedup", substring_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: A trained classifier and byte-level BPE are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written in the cluster's
    shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        path = fresh_dir(spark, f"corpus-{at}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
