"""Incremental runs with Structured Streaming (``availableNow`` + ``foreachBatch``)."""

from tidemark.streaming.incremental import upsert_stream

__all__ = ["upsert_stream"]
