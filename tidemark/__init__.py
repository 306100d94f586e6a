"""tidemark: Spark-native engagement analytics on semi-structured media data.

Library of DataFrame -> DataFrame functions (``functions``, ``operators``),
readers and writers at the edges (``sources``, ``sinks``), the layer jobs
that chain them (``plans``) and the incremental streaming driver
(``streaming``). The most used entry points are re-exported here.
"""

from tidemark.functions import asset_key, channel_of, key_present, mark_literal, parse_iso
from tidemark.operators.dedup import distinct_on, latest_per_key, newest_first, oldest_first
from tidemark.operators.incremental import accept_since, advance, allow_list, newer_than_mark
from tidemark.operators.kpi import distinct_visitors, top_videos, totals, visitors_by_channel
from tidemark.operators.upsert import upsert
from tidemark.session import build_session, configure

__version__ = "0.1.0"

__all__ = [
    "accept_since", "advance", "allow_list", "asset_key", "build_session", "channel_of",
    "configure", "distinct_on", "distinct_visitors", "key_present", "latest_per_key",
    "mark_literal", "newer_than_mark", "newest_first", "oldest_first", "parse_iso", "top_videos",
    "totals", "upsert", "visitors_by_channel",
]
