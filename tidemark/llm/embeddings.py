"""What both embedding operators share: usable vectors and groups of equal ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components present and finite."""
    value = lambda x: x.cast("double")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(value(x)) | (F.abs(value(x)) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(vector, rep, copies) of equal vectors in ``rows`` (id, vector): the smallest id
    and the number of rows. Partial sums meet, so a vector that a third of all rows
    share costs one row a task."""
    return rows.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
