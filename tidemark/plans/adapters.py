"""Raw, reference-shaped records derived by Spark from the test tables.

The test tables are a star schema, not media engagement data. These
functions re-shape them into the raw records the layer jobs consume, so
every query's work grows with the tables:

* ``events``   -> play events: visitor = ``user_id``, media = ``props.k``,
                  conversion type = ``event_type``; geo and browser come
                  from the visitor's ``customer`` / ``nation`` rows.
* ``part``     -> media metadata (nested structs, an ``assets`` array that
                  is NULL, empty or 1-3 long, with key collisions).
* ``customer`` -> visitor detail (two-level nested identity, absent org).
* ``events`` grouped per visitor -> the visitor list; per media -> the
  media summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import iso_utc_string, parse_iso
from tidemark.operators.joins import sized_broadcast
from tidemark.sources.testdata import Tables


def media_key(k: Column) -> Column:
    """Media id text for a part key / event media number."""
    return F.concat(F.lit("m"), k.cast("string"))


def event_media_number(events: DataFrame) -> Column:
    """``props.k`` of an event (JSON text). ``get_json_object`` stays inside
    whole-stage codegen (``from_json`` does not); ``try_cast`` turns a bad
    value into NULL under ANSI mode."""
    return F.get_json_object(F.col("props"), "$.k").try_cast("long")


def raw_events(t: Tables, with_profile: bool = True) -> DataFrame:
    """One raw event per ``events`` row (visitor geo/browser joined in).

    ``with_profile=False`` leaves the visitor profile fields NULL and skips
    the customer/nation join: for KPIs over (media, visitor) only, so the
    large events side is never joined or shuffled for columns it drops.
    """
    if with_profile:
        # Dimension first (customer + nation, both small relative to events),
        # then one size-checked broadcast join on the large events side.
        cust = (t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
                .join(t.nation.select("n_nationkey", "n_name", "n_regionkey"),
                      F.col("c_nationkey") == F.col("n_nationkey"), "left"))
        e = (t.events.withColumn("_k", event_media_number(t.events))
             .join(sized_broadcast(cust), F.col("user_id") == F.col("c_custkey"), "left"))
    else:
        e = t.events.withColumn("_k", event_media_number(t.events)).select(
            "*", *[F.lit(None).cast(ty).alias(c) for c, ty in
                   [("c_name", "string"), ("c_nationkey", "int"), ("c_mktsegment", "string"),
                    ("n_name", "string"), ("n_regionkey", "int")]])
    mid = media_key(F.col("_k"))
    return e.select(
        F.col("event_id").cast("string").alias("event_key"),
        iso_utc_string("ts").alias("received_at"),
        F.col("user_id").cast("string").alias("visitor_key"),
        F.concat_ws(".", F.lit("10"), F.col("c_nationkey").cast("string"),
                    F.pmod("user_id", F.lit(256)).cast("string")).alias("ip"),
        F.col("n_name").alias("country"),
        F.col("n_regionkey").cast("string").alias("region"),
        F.concat(F.col("n_name"), F.lit("-"), F.pmod("user_id", F.lit(5)).cast("string")).alias("city"),
        F.col("c_nationkey").cast("double").alias("lat"),
        F.col("n_regionkey").cast("double").alias("lon"),
        F.col("c_mktsegment").alias("org"),
        F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
        mid.alias("media_id"),
        F.concat(F.lit("Media "), F.col("_k").cast("string")).alias("media_name"),
        F.col("value").alias("percent_viewed"),
        F.col("event_type").alias("conversion_type"),
        F.concat(F.lit("https://embed.example/"), mid).alias("embed_url"),
        F.struct(F.col("c_mktsegment").alias("browser"),
                 F.when(F.pmod("user_id", F.lit(2)) == 0, "Windows").otherwise("iOS").alias("platform"),
                 (F.pmod("user_id", F.lit(2)) == 1).alias("mobile")).alias("user_agent_details"),
    )


def raw_event_versions(t: Tables) -> DataFrame:
    """The raw events, and a day older copy with another browser of every fifth:
    whoever keeps an arbitrary one of two versions gets a wrong row."""
    raw = raw_events(t)
    stale = (raw.where(F.pmod(F.col("event_key").cast("long"), F.lit(5)) == 0)
             .withColumn("received_at", iso_utc_string(
                 parse_iso("received_at") - F.expr("INTERVAL 1 DAY")))
             .withColumn("user_agent_details",
                         F.col("user_agent_details").withField("browser", F.lit("STALE"))))
    return stale.unionByName(raw)


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def media_title() -> Column:
    """A title per part whose words exercise every channel branch."""
    name, k = F.col("p_name"), F.pmod(F.col("p_partkey"), F.lit(8))
    return (F.when(k == 0, F.concat(name, F.lit(" on Facebook")))
            .when(k == 1, F.upper(F.concat(F.lit("FB "), name, F.lit(" yt"))))
            .when(k == 2, F.concat(name, F.lit(" - YouTube cut")))
            .when(k == 3, F.concat(F.lit("yt "), name))
            .when(k == 4, F.concat(name, F.lit(" bytes")))
            .when(k == 5, F.lit(None).cast("string"))
            .when(k == 6, F.lit(""))
            .otherwise(name))


def _asset(i: int) -> Column:
    """Asset ``i`` (0..2) of a part. Assets 1 and 2 share a type; when
    ``p_size % 3 == 0`` asset 1 lacks its height and asset 2 its width with
    the same other number, so their keys collide."""
    size = F.col("p_size").cast("long")
    gap = F.pmod(F.col("p_size"), F.lit(3)) == 0
    w = size * (16 * (i + 1))
    h = size * (9 * (i + 1))
    if i == 1:
        h = F.when(gap, F.lit(None).cast("long")).otherwise(h)
    if i == 2:
        w = F.when(gap, F.lit(None).cast("long")).otherwise(w)
        h = F.when(gap, size * 32).otherwise(h)
    kind = ["original", "mp4", "mp4"][i]
    return F.struct(w.alias("width"), h.alias("height"), F.lit(kind).alias("type"),
                    (F.col("p_partkey") * 1000 + i).alias("file_size"),
                    F.lit("video/mp4").alias("content_type"),
                    F.concat(F.lit("https://cdn.example/"), F.col("p_partkey").cast("string"),
                             F.lit(f"/{i}")).alias("url"))


def raw_media(t: Tables) -> DataFrame:
    """One raw media document per ``part`` row."""
    p = t.part
    hid = media_key(F.col("p_partkey"))
    n_assets = F.pmod(F.col("p_size"), F.lit(4))
    assets = F.when(F.pmod(F.col("p_size"), F.lit(5)) == 0, F.lit(None)) \
        .otherwise(F.slice(F.array(_asset(0), _asset(1), _asset(2)), F.lit(1), n_assets))
    return p.select(
        F.col("p_partkey").alias("id"), hid.alias("hashed_id"), media_title().alias("name"),
        F.col("p_retailprice").alias("duration"),
        F.concat(F.lit("2024-01-"), _two(F.pmod("p_size", F.lit(28)) + 1),
                 F.lit("T00:00:00Z")).alias("created"),
        F.concat(F.lit("2024-02-"), _two(F.pmod("p_partkey", F.lit(28)) + 1),
                 F.lit("T12:00:00Z")).alias("updated"),
        F.lit("ready").alias("status"),
        F.struct(F.col("p_size").cast("long").alias("id"), F.col("p_brand").alias("hashed_id"),
                 F.col("p_type").alias("name")).alias("folder"),
        F.when(F.pmod("p_size", F.lit(2)) == 0, F.lit(None)).otherwise(
            F.struct(F.col("p_brand").alias("hashed_id"),
                     F.lower(F.col("p_type")).alias("name"))).alias("subfolder"),
        F.struct(F.concat(F.lit("https://img.example/"), hid, F.lit(".jpg")).alias("url"),
                 (F.col("p_size").cast("long") * 16).alias("width"),
                 (F.col("p_size").cast("long") * 9).alias("height")).alias("thumbnail"),
        assets.alias("assets"),
    )


def raw_media_versions(t: Tables) -> DataFrame:
    """Two snapshots of the media documents: the original, and for parts
    with ``p_size > 25`` a later one with a changed title."""
    base = raw_media(t)
    later = (base.filter(F.col("folder.id") > 25)
             .withColumn("name", F.concat_ws(" ", F.col("name"), F.lit("(re-cut)")))
             .withColumn("updated", F.concat(F.lit("2024-03-"),
                                             _two(F.pmod("id", F.lit(28)) + 1),
                                             F.lit("T08:30:00+02:00"))))
    return base.unionByName(later)


def visitor_activity(t: Tables) -> DataFrame:
    """Per visitor: first/last event time, last event id, loads, plays.
    Partial aggregation: a visitor with a third of all events costs one row
    per map task in the shuffle."""
    return t.events.groupBy("user_id").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event_id"),
        F.count(F.lit(1)).alias("load_count"),
        F.count(F.when(F.col("event_type") == "view", F.lit(1))).alias("play_count"))


def visitor_list(t: Tables) -> DataFrame:
    """List records: ``visitor_key``, ``last_active_at`` text."""
    return visitor_activity(t).select(F.col("user_id").cast("string").alias("visitor_key"),
                                      iso_utc_string("last_ts").alias("last_active_at"))


def raw_visitor_detail(t: Tables) -> DataFrame:
    """Visitor detail documents of all customers; times and counts are NULL for
    those without events."""
    act = visitor_activity(t)
    c = t.customer.join(act, F.col("c_custkey") == F.col("user_id"), "left")
    odd = F.pmod("c_custkey", F.lit(2)) == 1
    return c.select(
        F.col("c_custkey").cast("string").alias("visitor_key"),
        iso_utc_string("first_ts").alias("created_at"),
        iso_utc_string("last_ts").alias("last_active_at"),
        F.col("last_event_id").cast("string").alias("last_event_key"),
        F.col("load_count").cast("long").alias("load_count"),
        F.col("play_count").cast("long").alias("play_count"),
        F.struct(F.col("c_name").alias("name"),
                 F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
                 F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(
                     F.struct(F.concat(F.lit("Org "), F.col("c_nationkey").cast("string")).alias("name"),
                              F.col("c_mktsegment").alias("title"))).alias("org")
                 ).alias("visitor_identity"),
        F.struct(F.col("c_mktsegment").alias("browser"),
                 F.col("c_nationkey").cast("string").alias("browser_version"),
                 F.when(odd, "iOS").otherwise("Windows").alias("platform"),
                 odd.alias("mobile")).alias("user_agent_details"),
    )


def media_summary(t: Tables) -> DataFrame:
    """Per media: loads, plays, play rate, hours watched, mean engagement,
    distinct visitors. Sums run on exact decimals, so any partition order
    gives the same double."""
    e = t.events.withColumn("_k", event_media_number(t.events))
    val = F.col("value").cast("decimal(18,2)")
    g = e.groupBy("_k").agg(
        F.count(F.lit(1)).alias("loads"),
        F.count(F.when(F.col("event_type") == "view", F.lit(1))).alias("plays"),
        F.sum(val).alias("total"),
        F.count_distinct("user_id").alias("visitors"))
    return g.select(
        media_key(F.col("_k")).alias("media_id"),
        F.col("loads").cast("long").alias("load_count"),
        F.col("plays").cast("long").alias("play_count"),
        (F.col("plays").cast("double") / F.col("loads").cast("double")).alias("play_rate"),
        (F.col("total").cast("double") / F.lit(60.0)).alias("hours_watched"),
        (F.col("total").cast("double") / F.col("loads").cast("double")).alias("engagement"),
        F.col("visitors").cast("long").alias("visitors"))
