import datetime as dt

from tidemark.functions import asset_key, channel_of, key_present, mark_literal, parse_iso


def test_channel_rule_first_match_and_substrings(spark):
    names = ["My FB ad", "YouTube cut", "bytes", "fb yt", None, "", "Facebook live",
             "plain title", "YT"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["name"]: r["c"] for r in df.select("name", channel_of("name").alias("c")).collect()}
    assert got["My FB ad"] == "Facebook"
    assert got["YouTube cut"] == "YouTube"
    assert got["bytes"] == "YouTube"          # substring 'yt'
    assert got["fb yt"] == "Facebook"         # first match wins
    assert got[None] == "Unknown"
    assert got[""] == "Unknown"
    assert got["Facebook live"] == "Facebook"
    assert got["plain title"] == "Unknown"
    assert got["YT"] == "YouTube"


def test_asset_key_skips_nulls_and_collides(spark):
    df = spark.createDataFrame(
        [("m", "mp4", 640, None), ("m", "mp4", None, 640), ("m", None, None, None),
         (None, None, None, None)],
        "media_id string, t string, w bigint, h bigint")
    keys = [r[0] for r in df.select(asset_key("media_id", "t", "w", "h")).collect()]
    assert keys == ["m_mp4_640", "m_mp4_640", "m", ""]


def test_key_present(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "k string")
    assert [r[0] for r in df.select(key_present("k")).collect()] == [True, False, False]


def test_parse_iso_orders_instants_and_tolerates_junk(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00.5Z", "2024-01-01T02:00:00+05:00",
             "garbage", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["p"] for r in df.select("t", parse_iso("t").alias("p")).collect()}
    assert got["2024-01-01T00:00:00Z"] == dt.datetime(2024, 1, 1)
    assert got["2024-01-01T00:00:00.5Z"] == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert got["2024-01-01T02:00:00+05:00"] == dt.datetime(2023, 12, 31, 21, 0)
    assert got["garbage"] is None and got[None] is None


def test_mark_literal_is_utc_regardless_of_input_zone(spark):
    aware = dt.datetime(2024, 1, 1, 5, tzinfo=dt.timezone(dt.timedelta(hours=5)))
    row = spark.range(1).select(mark_literal(aware).alias("a"),
                                mark_literal("2024-01-01T00:00:00Z").alias("b")).first()
    assert row["a"] == row["b"] == dt.datetime(2024, 1, 1)
    assert spark.range(1).select(mark_literal("2024-01-01T00:00:00Z").cast("string")).first()[0] \
        == "2024-01-01 00:00:00"
