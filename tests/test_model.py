from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import model
from tidemark.operators.flatten import flatten_media
from tests.conftest import rows


def test_curated_dim_media_latest_by_instant_not_text(spark):
    raw = spark.createDataFrame([
        {"hashed_id": "m1", "name": "old FB", "updated": "2024-01-01T10:00:00+05:00"},  # 05:00Z
        {"hashed_id": "m1", "name": "new yt", "updated": "2024-01-01T06:00:00Z"},       # newer
        {"hashed_id": "m2", "name": None, "updated": None},
    ], schemas.MEDIA_METADATA)
    got = rows(model.curated_dim_media(raw), "media_id", "title", "channel")
    assert got == [("m1", "new yt", "YouTube"), ("m2", None, "Unknown")]


def test_gold_dim_media_one_row_per_media_from_latest_update(spark):
    raw = spark.createDataFrame([
        {"hashed_id": "m1", "name": "v1", "updated": "2024-01-01T00:00:00Z",
         "assets": [{"type": "mp4", "width": 1}, {"type": "hls", "width": 2}]},
        {"hashed_id": "m1", "name": "facebook v2", "updated": "2024-02-01T00:00:00Z",
         "assets": [{"type": "mp4", "width": 1}]},
    ], schemas.MEDIA_METADATA).withColumn("ingestion_time", F.lit(None).cast("timestamp_ntz"))
    gold = model.gold_dim_media(flatten_media(raw))
    assert rows(gold, "media_id", "title", "channel", "updated_at") == [
        ("m1", "facebook v2", "Facebook", "2024-02-01T00:00:00Z")]


def test_curated_dim_visitor_takes_latest_event(spark):
    ev = spark.createDataFrame(
        [("e1", "2024-01-01T00:00:00Z", "v1", "1.1.1.1", "FR"),
         ("e2", "2024-01-03T00:00:00Z", "v1", "2.2.2.2", "DE"),
         ("e3", None, "v2", "3.3.3.3", "US")],
        "event_key string, received_at string, visitor_key string, ip string, country string")
    ev = ev.select("*", *[F.lit(None).cast("string").alias(c) for c in
                          ("region", "city", "browser", "platform")],
                   F.lit(None).cast("boolean").alias("is_mobile"))
    got = rows(model.curated_dim_visitor(ev), "visitor_id", "ip_address", "country")
    assert got == [("v1", "2.2.2.2", "DE"), ("v2", "3.3.3.3", "US")]


def test_fact_media_engagement_dedup_is_deterministic(spark):
    ms = spark.createDataFrame([("m1", 10, 5, 0.5, 1.0, 2.0, 3), ("m1", 10, 7, 0.7, 1.0, 2.0, 3)],
                               schemas.MEDIA_SUMMARY)
    out = model.fact_media_engagement(ms)
    assert rows(out, "media_id", "play_count", "total_hours_watched", "unique_visitors") == [
        ("m1", 7, 1.0, 3)]
