"""Explicit schemas of the raw JSON inputs and the state table.

Declared rather than inferred: inference turns key directories such as
``visitor_key=0012`` into numbers, fails on structs or arrays that happen to
be absent in one run, and costs an extra pass over the input.
"""

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The field names of the raw JSON records below (and of the
# state table) must equal the source data's; the types are our choice.

# One object per file under visitor_detail/visitor_key=<k>/.
VISITOR_DETAIL = _struct(
    ("visitor_key", S), ("created_at", S), ("last_active_at", S), ("last_event_key", S),
    ("load_count", L), ("play_count", L),
    ("visitor_identity", _struct(("name", S), ("email", S),
                                 ("org", _struct(("name", S), ("title", S))))),
    ("user_agent_details", _struct(("browser", S), ("browser_version", S),
                                   ("platform", S), ("mobile", B))),
)

ASSET = _struct(("width", L), ("height", L), ("type", S), ("file_size", L),
                ("content_type", S), ("url", S))

# One object per file under media_metadata/media_id=<id>/.
MEDIA_METADATA = _struct(
    ("id", L), ("hashed_id", S), ("name", S), ("duration", D), ("created", S), ("updated", S),
    ("status", S),
    ("folder", _struct(("id", L), ("hashed_id", S), ("name", S))),
    ("subfolder", _struct(("hashed_id", S), ("name", S))),
    ("thumbnail", _struct(("url", S), ("width", L), ("height", L))),
    ("assets", T.ArrayType(ASSET)),
)

# A JSON array of these per file under events/page=<n>/ (or one per line).
EVENT = _struct(
    ("event_key", S), ("received_at", S), ("visitor_key", S), ("ip", S), ("country", S),
    ("region", S), ("city", S), ("lat", D), ("lon", D), ("org", S), ("email", S),
    ("media_id", S), ("media_name", S), ("percent_viewed", D), ("conversion_type", S),
    ("embed_url", S),
    ("user_agent_details", _struct(("browser", S), ("platform", S), ("mobile", B))),
)

# Flat per-media summary records.
MEDIA_SUMMARY = _struct(
    ("media_id", S), ("load_count", L), ("play_count", L), ("play_rate", D),
    ("hours_watched", D), ("engagement", D), ("visitors", L),
)

# Visitor list records (list endpoint): key and last activity.
VISITOR_LIST = _struct(("visitor_key", S), ("last_active_at", S))

# High-water-mark state: one row per mark name.
WATERMARKS = T.StructType([
    T.StructField("name", S, False),
    T.StructField("watermark", T.TimestampNTZType(), True),
])

# Landing partition columns (directory values), typed as text on purpose.
PARTITION_COLUMNS = {"visitor_key": S, "media_id": S, "page": S, "received_date": S}


def with_partition(schema: T.StructType, *names: str) -> T.StructType:
    """Schema plus partition-directory columns not already in it."""
    have = set(schema.fieldNames())
    extra = [T.StructField(n, PARTITION_COLUMNS.get(n, S), True) for n in names if n not in have]
    return T.StructType(list(schema.fields) + extra)
