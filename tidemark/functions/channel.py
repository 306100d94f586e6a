"""Channel of a media title (lower-cased substring rule, first match wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Must equal the reference's rule, in its order.
# (substring of the lower-cased title, channel)
CHANNEL_RULES = [
    ("facebook", "Facebook"),
    ("fb", "Facebook"),
    ("youtube", "YouTube"),
    ("yt", "YouTube"),
]
UNKNOWN_CHANNEL = "Unknown"


def channel_of(title: Column | str) -> Column:
    """``Facebook`` / ``YouTube`` / ``Unknown``; NULL and '' give ``Unknown``."""
    t = F.lower(F.col(title) if isinstance(title, str) else title)
    expr = None
    for needle, channel in CHANNEL_RULES:
        cond = t.contains(needle)
        expr = F.when(cond, F.lit(channel)) if expr is None else expr.when(cond, F.lit(channel))
    return expr.otherwise(F.lit(UNKNOWN_CHANNEL))
