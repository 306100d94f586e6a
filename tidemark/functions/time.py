"""Timestamps: ISO-8601 text in, UTC ``TIMESTAMP_NTZ`` inside.

Everything the library stores or compares is a UTC wall-clock
``TIMESTAMP_NTZ``; the session time zone is pinned to UTC
(:func:`tidemark.session.configure`), so casts between the two timestamp
types never shift a value.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 text (``Z``, ``+hh:mm`` or no zone = UTC) -> UTC TIMESTAMP_NTZ.

    Bad text gives NULL instead of failing the job (ANSI mode is on), and so
    does a year outside 1 to 9999, which neither a date folder nor a mark can hold.
    """
    c = F.col(text) if isinstance(text, str) else text
    t = F.try_to_timestamp(c).cast(T.TimestampNTZType())
    return F.when(F.year(t).between(1, 9999), t)


def iso_utc_string(ts: Column | str) -> Column:
    """UTC TIMESTAMP_NTZ -> ``yyyy-MM-ddTHH:mm:ss.SSSSSSZ``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def to_utc_naive(mark: dt.datetime | str) -> dt.datetime:
    """Python datetime or ISO text -> naive UTC datetime."""
    if isinstance(mark, str):
        mark = dt.datetime.fromisoformat(mark.replace("Z", "+00:00"))
    if mark.tzinfo is not None:
        mark = mark.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return mark


def mark_literal(mark: dt.datetime | str, dtype: T.DataType | None = None) -> Column:
    """A high-water mark as a typed literal matching a column of ``dtype``.

    Built from text, never from a naive Python datetime (which PySpark would
    read in the driver's local zone).
    """
    text = to_utc_naive(mark).isoformat(sep=" ")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + "+00:00").cast(T.TimestampType())
    return F.lit(text).cast(T.TimestampNTZType())
