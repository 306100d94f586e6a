"""VARIANT values against declared types.

A cast does not tell of a bad value inside a struct or an array: it gives NULL there. So a
value is bad where the cast has NULL and the VARIANT has something, which is looked
up only where the cast has NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _given(value: Column, path: str) -> Column:
    """Whether there is a value at ``path``; JSON null is none."""
    return F.try_variant_get(value, path, "string").isNotNull()


def misfit(value: Column, kind: T.DataType, typed: Column, path: str = "$") -> Column:
    """Whether the VARIANT ``value`` holds something at ``path`` that does not convert to
    ``kind``, at any depth. ``typed`` is the value there, cast to ``kind``."""
    missing = typed.isNull() & _given(value, path)
    if isinstance(kind, T.StructType):
        inner = F.lit(False)
        for f in kind.fields:
            inner = inner | misfit(value, f.dataType, typed[f.name], f"{path}.{f.name}")
        return missing | (typed.isNotNull() & inner)
    if isinstance(kind, T.ArrayType):
        item = kind.elementType
        pairs = F.arrays_zip(typed.alias("t"), F.try_variant_get(value, path, "array<variant>").alias("v"))
        bad = F.exists(pairs, lambda p: misfit(p["v"], item, p["t"]))
        return missing | F.coalesce(F.exists(typed, lambda t: _has_null(t, item)) & bad, F.lit(False))
    return missing


def _has_null(typed: Column, kind: T.DataType) -> Column:
    """Whether a cast value is NULL somewhere, so that its source has to be looked at."""
    if isinstance(kind, T.StructType):
        out = typed.isNull()
        for f in kind.fields:
            out = out | _has_null(typed[f.name], f.dataType)
        return out
    if isinstance(kind, T.ArrayType):
        return typed.isNull() | F.coalesce(F.exists(typed, lambda t: _has_null(t, kind.elementType)),
                                           F.lit(False))
    return typed.isNull()
