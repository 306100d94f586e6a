"""Latest record per key (W1) and distinct-on with a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keyfilter import holds_not, key_filter, might_hold
from tidemark.operators.upsert import materialize


def newest_first(*cols: str | Column) -> list[Column]:
    """Descending order, NULLs last: a NULL time loses to any value but is
    kept when it is a key's only row."""
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in cols]


def oldest_first(*cols: str | Column) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in cols]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   rank_col: str = "_rank") -> DataFrame:
    """Keep the first row of each key under ``order`` (give a total order).

    Planned as a rank-1 window: Spark inserts a partial ``WindowGroupLimit``
    before the shuffle, so each map task sends at most one row per key and a
    key holding a third of all rows costs no more shuffle than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))


def latest_of_few(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """:func:`latest_per_key` of stored rows most of which are alone with their key. A pass over
    the keys finds those that come twice, as key bits; only rows that may have one of these
    are shuffled and sorted. Do not give it rows that are costly to compute: they are read
    up to three times."""
    keys = list(keys)
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    bits = materialize(key_filter(twice, keys))
    if bits.isEmpty():
        return df
    some = latest_per_key(might_hold(df, bits, keys), keys, order)
    return holds_not(df, bits, keys).unionByName(some)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the survivor chosen by ``order`` (deterministic,
    unlike ``dropDuplicates``, whose survivor is arbitrary)."""
    return latest_per_key(df, keys, order)
