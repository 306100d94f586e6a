"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def asset_key(*parts: Column | str, sep: str = "_") -> Column:
    """Composite key of a media asset: parts joined by ``sep``, NULL parts
    skipped (so (640, NULL) and (NULL, 640) collide, as in the source data)."""
    return F.concat_ws(sep, *[F.col(p) if isinstance(p, str) else p for p in parts])


def key_present(key: Column | str) -> Column:
    """True when a key is neither NULL nor the empty string."""
    k = F.col(key) if isinstance(key, str) else key
    return k.isNotNull() & (k.cast("string") != F.lit(""))
