"""Dimension and fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.channel import channel_of
from tidemark.functions.time import parse_iso
from tidemark.operators.dedup import latest_per_key, newest_first, oldest_first


def _order_time(col: str) -> F.Column:
    """Order by the instant a text time denotes (not its spelling)."""
    return parse_iso(col)


def gold_dim_media(silver_media: DataFrame) -> DataFrame:
    """gold ``dim_media``: one row per media (silver holds one per asset).

    The survivor is the most recently updated row (then newest ingestion,
    then asset key), not an arbitrary asset row.
    """
    cols = [F.col("media_id"), F.col("media_name").alias("title"), F.col("thumbnail_url"),
            F.col("duration"), F.col("status"), F.col("folder_name"), F.col("subfolder_name"),
            channel_of("media_name").alias("channel"),
            F.col("created_at"), F.col("updated_at"), F.col("ingestion_time")]
    ranked = latest_per_key(
        silver_media.withColumn("_upd", _order_time("updated_at")), ["media_id"],
        newest_first("_upd", "ingestion_time") + oldest_first("media_asset_key"))
    return ranked.select(*cols)


def gold_dim_visitor(silver_visitors: DataFrame) -> DataFrame:
    """gold ``dim_visitor``: profile columns, one row per visitor (latest activity)."""
    cols = ["visitor_key", "visitor_name", "visitor_email", "visitor_title",
            "organization_name", "created_at", "last_active_at", "browser",
            "browser_version", "platform", "is_mobile", "ingestion_time"]
    ranked = latest_per_key(silver_visitors.withColumn("_act", _order_time("last_active_at")),
                            ["visitor_key"], newest_first("_act", "ingestion_time"))
    return ranked.select(*cols)


def curated_dim_media(raw_media: DataFrame) -> DataFrame:
    """curated ``dim_media`` from raw media snapshots: latest by ``updated``."""
    ranked = latest_per_key(raw_media.withColumn("_upd", _order_time("updated")),
                            ["hashed_id"], newest_first("_upd")
                            + oldest_first("name", "created", "thumbnail.url"))
    return ranked.select(F.col("hashed_id").alias("media_id"), F.col("name").alias("title"),
                         F.col("thumbnail.url").alias("url"),
                         channel_of("name").alias("channel"),
                         F.col("created").alias("created_at"))


def curated_dim_visitor(events: DataFrame) -> DataFrame:
    """curated ``dim_visitor`` (geo profile) from flattened events: the
    visitor's most recent event wins."""
    ranked = latest_per_key(events.withColumn("_rcv", _order_time("received_at")),
                            ["visitor_key"], newest_first("_rcv") + oldest_first("event_key"))
    return ranked.select(F.col("visitor_key").alias("visitor_id"), F.col("ip").alias("ip_address"),
                         "country", "region", "city", "browser", "platform", "is_mobile")


def fact_media_engagement(media_summary: DataFrame) -> DataFrame:
    """curated ``fact_media_engagement``: one row per media."""
    ranked = latest_per_key(media_summary, ["media_id"],
                            newest_first("play_count", "load_count", "hours_watched",
                                         "visitors", "engagement", "play_rate"))
    return ranked.select("media_id", "load_count", "play_count", "play_rate",
                         F.col("hours_watched").alias("total_hours_watched"),
                         F.col("engagement").alias("average_engagement"),
                         F.col("visitors").alias("unique_visitors"))


def fact_visitor_engagement(events: DataFrame) -> DataFrame:
    """curated ``fact_visitor_engagement``: one row per event key."""
    ranked = latest_per_key(events.withColumn("_rcv", _order_time("received_at")),
                            ["event_key"], newest_first("_rcv"))
    return visitor_engagement_rows(ranked)


def visitor_engagement_rows(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The fact's columns, for events that have one row a key already."""
    return events.select("event_key", "media_id", F.col("visitor_key").alias("visitor_id"),
                         F.col("received_at").alias("event_timestamp"), "percent_viewed",
                         "browser", "country", "embed_url", *keep)
