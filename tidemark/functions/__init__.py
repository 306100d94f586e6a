"""Column expressions (all built-in Spark functions, no UDF)."""

from tidemark.functions.channel import channel_of
from tidemark.functions.keys import asset_key, key_present
from tidemark.functions.time import iso_utc_string, mark_literal, parse_iso

__all__ = ["channel_of", "asset_key", "key_present", "iso_utc_string", "mark_literal", "parse_iso"]
