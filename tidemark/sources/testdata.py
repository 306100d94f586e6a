"""The driver's Parquet test tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables:
    """Lazy readers of one scale factor's tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")
