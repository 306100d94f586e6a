"""SQL access to named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames as temp views for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The named table, or None when it does not exist (the caller skips
    that section instead of failing)."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def select_present(df: DataFrame, *cols: str) -> DataFrame:
    """Select the wanted columns that the table has (column-presence guard)."""
    return df.select(*[c for c in cols if c in df.columns])
