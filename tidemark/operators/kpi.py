"""KPI queries over the engagement facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import sized_broadcast
from tidemark.operators.upsert import materialize


def distinct_visitors(fact: DataFrame, keys: Sequence[str], visitor: str = "visitor_id",
                      out: str = "number_of_visitors", drop_null_keys: bool = False,
                      order: str = "count", approx_rsd: float | None = None) -> DataFrame:
    """Exact distinct visitors per group.

    ``drop_null_keys=False`` keeps a NULL group (SQL ``GROUP BY``);
    True drops it (the dashboard's pandas ``groupby``). NULL visitors are not
    counted. ``order='count'`` sorts by the count, descending, ties by key;
    ``order='key'`` sorts by key.

    Plan: Spark rewrites the distinct count into two aggregations - first on
    ``(keys, visitor)``, which spreads a hot key over many tasks and combines
    map-side, then on ``keys`` with partial counts.

    ``approx_rsd`` (opt-in, e.g. 0.01) counts with a HyperLogLog++ sketch of
    that relative standard deviation instead: one shuffle of small sketches
    per key and task, for visitor counts in the billions.
    """
    keys = list(keys)
    src = fact.select(*keys, visitor)
    if drop_null_keys:
        for k in keys:
            src = src.filter(F.col(k).isNotNull())
    counter = (F.approx_count_distinct(visitor, approx_rsd) if approx_rsd is not None
               else F.count_distinct(visitor))
    agg = src.groupBy(*keys).agg(counter.cast("long").alias(out))
    if order == "count":
        return agg.orderBy(F.col(out).desc(), *[F.col(k).asc_nulls_last() for k in keys])
    if order == "key":
        return agg.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    return agg


def visitors_by_channel(fact: DataFrame, dim_media: DataFrame, visitor: str = "visitor_id",
                        out: str = "number_of_visitors",
                        approx_rsd: float | None = None) -> DataFrame:
    """Distinct visitors per channel: fact -> media -> channel.

    The (media, visitor) pairs are made distinct before the join (map-side
    combine shrinks a hot media to its distinct visitors), the media->channel
    lookup is computed once, measured and broadcast only if proven small, and a
    fact media missing from the dimension counts under a NULL channel.
    """
    pairs = fact.select("media_id", visitor).distinct()
    dim = sized_broadcast(materialize(dim_media.select("media_id", "channel")))
    joined = pairs.join(dim, on="media_id", how="left")
    return distinct_visitors(joined, ["channel"], visitor=visitor, out=out, approx_rsd=approx_rsd)


def top_videos(fact_media: DataFrame, dim_media: DataFrame, n: int | None = None) -> DataFrame:
    """Fact joined to its media dimension, ``play_count`` descending (ties by
    ``media_id``). ``n`` keeps the first n (a top-k report); None keeps all."""
    dim = sized_broadcast(materialize(dim_media.select("media_id", "title", "channel")))
    out = (fact_media.join(dim, on="media_id", how="inner")
           .select("media_id", "title", "channel", "total_hours_watched", "play_count")
           .orderBy(F.col("play_count").desc_nulls_last(), F.col("media_id").asc()))
    return out.limit(n) if n is not None else out


def totals(fact: DataFrame) -> DataFrame:
    """One row: events, distinct media, distinct visitors (NULLs not counted);
    a missing column counts 0, as the dashboard does.

    The fact is reduced to its (media, visitor) pairs with a count first, so that
    only pairs, not fact rows, are expanded for the two distinct counts."""
    known = [c for c in ("media_id", "visitor_id") if c in fact.columns]

    def nunique(c):
        return F.count_distinct(c).cast("long") if c in known else F.lit(0).cast("long")
    pairs = fact.groupBy(*known).agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_events"),
                     nunique("media_id").alias("unique_videos"),
                     nunique("visitor_id").alias("unique_visitors"))


def first_numeric_column(df: DataFrame, exclude: Sequence[str] = ()) -> str | None:
    """Name of the first numeric column (the chart series of a KPI table)."""
    for f in df.schema.fields:
        if f.name not in exclude and isinstance(f.dataType, T.NumericType):
            return f.name
    return None


def chart_series(df: DataFrame, x: str) -> DataFrame | None:
    """``(x, first numeric column)`` of a KPI table, or None when ``x`` or a
    numeric column is missing (the dashboard then skips the chart)."""
    if x not in df.columns:
        return None
    y = first_numeric_column(df, exclude=[x])
    return df.select(x, y) if y else None


def preview(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """First ``n`` rows in ``order`` (a top-k: one sort per task, n rows moved)."""
    return df.orderBy(*order).limit(n)
