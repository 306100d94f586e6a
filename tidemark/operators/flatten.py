"""Flattening of nested records.

A flattening is a list of ``(path, name)`` pairs: dotted struct paths
(one or more levels) selected under a flat name. Selecting by path lets
Catalyst prune nested columns down to the leaves read from Parquet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import asset_key

Spec = Sequence[tuple[str, str]]


def flatten(df: DataFrame, spec: Spec, keep: Sequence[str] = ()) -> DataFrame:
    """Select each dotted ``path`` as ``name``; ``keep`` columns are passed through."""
    return df.select(*[F.col(p).alias(n) for p, n in spec], *keep)


def explode_outer_struct(df: DataFrame, array_col: str, spec: Spec, alias: str = "_elem",
                         keep: Sequence[str] | None = None) -> DataFrame:
    """One row per array element, its fields flattened by ``spec`` (paths
    relative to the element). Rows whose array is NULL or empty stay, once,
    with NULL element fields."""
    keep = [c for c in (keep if keep is not None else df.columns) if c != array_col]
    exploded = df.select(*keep, F.explode_outer(array_col).alias(alias))
    return exploded.select(*keep, *[F.col(f"{alias}.{p}").alias(n) for p, n in spec])


# --- reference-shaped layer flatteners -----------------------------------

# Silver media columns (name in bronze -> name in silver).
MEDIA_SPEC = [
    ("id", "provider_media_id"), ("hashed_id", "media_id"), ("name", "media_name"),
    ("duration", "duration"), ("created", "created_at"), ("updated", "updated_at"),
    ("status", "status"),
    ("folder.id", "folder_id"), ("folder.hashed_id", "folder_hashed_id"),
    ("folder.name", "folder_name"),
    ("subfolder.hashed_id", "subfolder_hashed_id"), ("subfolder.name", "subfolder_name"),
    ("thumbnail.url", "thumbnail_url"), ("thumbnail.width", "thumbnail_width"),
    ("thumbnail.height", "thumbnail_height"),
]
ASSET_SPEC = [
    ("width", "asset_width"), ("height", "asset_height"), ("type", "asset_type"),
    ("file_size", "asset_file_size"), ("content_type", "asset_content_type"),
    ("url", "asset_url"),
]

# Silver visitor columns.
VISITOR_SPEC = [
    ("visitor_key", "visitor_key"), ("created_at", "created_at"),
    ("last_active_at", "last_active_at"), ("last_event_key", "last_event_key"),
    ("load_count", "load_count"), ("play_count", "play_count"),
    ("visitor_identity.name", "visitor_name"), ("visitor_identity.email", "visitor_email"),
    ("visitor_identity.org.title", "visitor_title"),
    ("visitor_identity.org.name", "organization_name"),
    ("user_agent_details.browser", "browser"),
    ("user_agent_details.browser_version", "browser_version"),
    ("user_agent_details.platform", "platform"), ("user_agent_details.mobile", "is_mobile"),
]

# Refined visitor detail columns (full-refresh variant, other names).
VISITOR_DETAIL_SPEC = [
    ("visitor_key", "visitor_key"), ("created_at", "created_at"),
    ("last_active_at", "last_active_at"), ("last_event_key", "last_event_key"),
    ("load_count", "load_count"), ("play_count", "play_count"),
    ("visitor_identity.name", "visitor_name"), ("visitor_identity.email", "visitor_email"),
    ("visitor_identity.org.name", "org_name"), ("visitor_identity.org.title", "org_title"),
    ("user_agent_details.browser", "browser"),
    ("user_agent_details.browser_version", "browser_version"),
    ("user_agent_details.platform", "platform"), ("user_agent_details.mobile", "mobile"),
]

# Silver event columns.
EVENT_SPEC = [
    ("event_key", "event_key"), ("received_at", "received_at"),
    ("visitor_key", "visitor_key"), ("ip", "ip"), ("country", "country"),
    ("region", "region"), ("city", "city"), ("lat", "lat"), ("lon", "lon"), ("org", "org"),
    ("email", "email"), ("media_id", "media_id"), ("media_name", "media_name"),
    ("percent_viewed", "percent_viewed"), ("conversion_type", "conversion_type"),
    ("embed_url", "embed_url"),
    ("user_agent_details.browser", "browser"), ("user_agent_details.platform", "platform"),
    ("user_agent_details.mobile", "is_mobile"),
]

MEDIA_ASSET_KEY = "media_asset_key"


def flatten_media(bronze: DataFrame, keep: Sequence[str] = ("ingestion_time",)) -> DataFrame:
    """Bronze media -> one row per asset (a media without assets keeps one
    row), plus ``media_asset_key = media_id_type_width_height``."""
    keep = [c for c in keep if c in bronze.columns]
    media_cols = [n for _, n in MEDIA_SPEC]
    base = flatten(bronze, MEDIA_SPEC, keep=["assets", *keep])
    rows = explode_outer_struct(base, "assets", ASSET_SPEC, keep=[*media_cols, *keep])
    rows = rows.select(*media_cols, *[n for _, n in ASSET_SPEC], *keep)
    return rows.withColumn(MEDIA_ASSET_KEY, asset_key("media_id", "asset_type",
                                                      "asset_width", "asset_height"))


def flatten_visitors(bronze: DataFrame, keep: Sequence[str] = ("ingestion_time",)) -> DataFrame:
    return flatten(bronze, VISITOR_SPEC, keep=[c for c in keep if c in bronze.columns])


def flatten_visitor_detail(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return flatten(raw, VISITOR_DETAIL_SPEC, keep=keep)


def flatten_events(bronze: DataFrame, keep: Sequence[str] = ("ingestion_time",)) -> DataFrame:
    return flatten(bronze, EVENT_SPEC, keep=[c for c in keep if c in bronze.columns])
