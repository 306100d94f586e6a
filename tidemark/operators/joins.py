"""Join helpers: broadcast a side only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_CONF = "tidemark.broadcast.maxBytes"


def broadcast_limit(df: DataFrame) -> int:
    """Byte limit for broadcasting (session conf ``tidemark.broadcast.maxBytes``)."""
    v = df.sparkSession.conf.get(BROADCAST_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES


def _row_bytes(schema: T.StructType) -> Column:
    """Upper-ish bound of a row's in-memory size, computed per row."""
    parts = [F.lit(16)]
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + F.lit(16))
        else:
            parts.append(F.lit(8))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


def fits_in_broadcast(df: DataFrame, limit_bytes: int | None = None) -> bool:
    """True when ``df`` is proven to fit ``limit_bytes``.

    One aggregate job with map-side partial sums: every task sends one row,
    so the check never funnels data into a single task. Run it on a side that
    is small or already persisted (batch keys, a dimension).
    """
    limit_bytes = limit_bytes or broadcast_limit(df)
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.sum(_row_bytes(df.schema)).alias("bytes")).first()
    return (row["bytes"] or 0) <= limit_bytes


def sized_broadcast(df: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its measured size is within the limit; otherwise
    ``df`` with a ``merge`` join hint, so Spark's own size estimate (from
    compressed file sizes, often several times too small) cannot broadcast
    it anyway: both sides are shuffled and AQE splits skewed partitions."""
    return F.broadcast(df) if fits_in_broadcast(df, limit_bytes) else df.hint("merge")


# --- hot keys --------------------------------------------------------------------

MOST_HOT = 64             # keys that are looked at; more cannot each hold 1/64 of the rows
TRACKED = 4096            # items that the sketch follows


def hot_keys(df: DataFrame, key: str, share: float) -> dict:
    """Keys that hold at least ``share`` of the rows (1/64 or more), with their share: one
    aggregate over the key column, a sketch of bounded size a task."""
    row = df.agg(F.expr(f"approx_top_k(`{key}`, {MOST_HOT}, {TRACKED})").alias("top"),
                 F.count(F.lit(1)).alias("n")).first()
    return {t["item"]: t["count"] / row["n"] for t in row["top"]
            if t["item"] is not None and t["count"] >= max(share, 1 / MOST_HOT) * row["n"]}


def split_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner",
               parts: int | None = None) -> DataFrame:
    """``fact`` joined with ``dim`` on ``key`` (inner or left) where few keys hold many rows.

    Rows of hot keys, those that would fill more than one of ``parts`` shuffle partitions,
    carry a salt, and the dimension rows of these keys are repeated a salt each; all others
    join plainly. For dimensions too large to broadcast. The salt is a hash of the row, so a
    task that is run again deals rows as before; equal rows of a hot key share a salt.
    A key that is NULL matches nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    parts = parts or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(fact, key, 1 / parts)
    if not hot:
        return fact.join(dim.hint("merge"), key, how)
    is_hot = F.coalesce(F.col(f"`{key}`").isin(list(hot)), F.lit(False))
    salts = F.lit(0)
    for item, share in hot.items():      # four salts a partition's worth of rows even out
        salts = F.when(F.col(f"`{key}`") == F.lit(item), F.lit(max(1, round(4 * share * parts)))).otherwise(salts)
    hashed = [F.col(f"`{f.name}`") for f in fact.schema.fields if not isinstance(f.dataType, T.MapType)]
    salted = fact.where(is_hot).withColumn("_salt", F.pmod(F.xxhash64(*hashed), salts.cast("long")))
    copies = dim.where(is_hot).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1)))
    out = salted.join(copies.hint("merge"), [key, "_salt"], how).drop("_salt")
    return out.unionByName(fact.where(~is_hot).join(dim.where(~is_hot).hint("merge"), key, how))
