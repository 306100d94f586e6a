"""A bit set over keys, to drop rows that cannot match before they are shuffled.

For merges whose batch is too large to broadcast: the batch keys set bits in a bit
set of fixed size, which is broadcast and tested in the scan of the target. A key of
the batch always passes; another one passes by chance and costs time, no more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26       # 2^26 bits: 8 MiB, whatever the number of keys


def _slot(keys: Sequence[str], side: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"{side}.{k}") for k in keys]), F.lit(1 << BITS)) + 1


def key_filter(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(bucket, bits): at most 2048 rows of 4 KiB."""
    slot = _slot(keys, "b")
    return (rows.alias("b").groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")))


def _test(target: DataFrame, bits: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    slot = _slot(keys, "t")
    at = F.bitmap_bit_position(slot)
    byte = F.substring(F.col("f.bits"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), at.bitwiseAND(F.lit(7)).cast("int"))
    return target.alias("t").join(F.broadcast(bits.alias("f")),
                                  (F.bitmap_bucket_number(slot) == F.col("f.bucket")) & (bit == 1),
                                  how).select("t.*")


def might_hold(target: DataFrame, bits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key may be one that ``bits`` was made from."""
    return _test(target, bits, keys, "left_semi")


def holds_not(target: DataFrame, bits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The other rows: their key is surely none that ``bits`` was made from."""
    return _test(target, bits, keys, "left_anti")
