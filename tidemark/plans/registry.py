"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query runs a library operator or layer job over the whole test tables
(or data Spark derives from them). The equivalent DuckDB SQL for each is in
:mod:`tidemark.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.channel import channel_of
from tidemark.functions.time import iso_utc_string, mark_literal, parse_iso
from tidemark.operators import dedup, incremental, kpi, model, report, sketches
from tidemark.operators.flatten import (MEDIA_ASSET_KEY, flatten_events, flatten_media,
                                        flatten_visitor_detail, flatten_visitors)
from tidemark.operators.joins import split_join
from tidemark.operators.stamp import stamp
from tidemark.operators.upsert import upsert
from tidemark.plans import adapters, jobs
from tidemark.session import configure, fresh_dir
from tidemark.sinks import land_json, write_json_sample
from tidemark.sources import catalog
from tidemark.sources.append import AppendTable
from tidemark.sources.files import read_json
from tidemark.sources.partitioned import PartitionedTable
from tidemark.sources.snapshots import SnapshotTable
from tidemark.sources.state import WatermarkStore
from tidemark.sources.testdata import Tables
from tidemark.streaming.incremental import upsert_stream
from tidemark.streaming.late import keep_in_time

# Fixed query parameters (marks, lists, stamp time).
EVENTS_MARK = "2024-01-15T00:00:00Z"
ADVANCE_MARK = "2024-01-20T00:00:00Z"
FUTURE_MARK = "2100-01-01T00:00:00Z"
VISITOR_LIST_MARK = "2024-01-29T00:00:00Z"
ALLOWED_EVENT_TYPES = ("view", "purchase")
STAMP_TIME = "2025-01-01T00:00:00Z"
SKETCH_FROM = "2024-01-10"

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    configure(spark)
    return Tables(spark, sf_dir)


def silver_events(t: Tables) -> DataFrame:
    """Flattened events, one row per event key."""
    flat = flatten_events(adapters.raw_events(t))
    return dedup.distinct_on(flat, ["event_key"], dedup.newest_first("received_at"))


def fact_events(t: Tables, with_profile: bool = True) -> DataFrame:
    """The visitor engagement fact; ``with_profile=False`` for KPIs that use
    only media and visitor columns (no join to the visitor profile)."""
    return model.fact_visitor_engagement(flatten_events(adapters.raw_events(t, with_profile)))


def dim_media(t: Tables) -> DataFrame:
    return model.curated_dim_media(adapters.raw_media_versions(t))


# --- scans and projections -------------------------------------------------

def q_scan_all(spark, sf_dir):
    return _t(spark, sf_dir).nation.select("*")


def q_project_rename(spark, sf_dir):
    c = _t(spark, sf_dir).customer
    return c.select(F.col("c_custkey").alias("visitor_id"), F.col("c_name").alias("visitor_name"),
                    F.col("c_mktsegment").alias("browser"),
                    F.col("c_nationkey").alias("country_id"), F.col("c_acctbal").alias("balance"))


def q_nested_access(spark, sf_dir):
    """Refined visitor detail (D8): 1- and 2-level struct paths."""
    return flatten_visitor_detail(adapters.raw_visitor_detail(_t(spark, sf_dir)))


# Asset numbers are NULL for media without assets; returned as DOUBLE so a
# NULL compares the same under any engine's dataframe conversion (a NULL
# bigint becomes float NaN in one and a nullable integer in another).
ASSET_NUMBERS = ("asset_width", "asset_height", "asset_file_size")


def _as_double(*cols: str) -> list:
    return [F.col(c).cast("double").alias(c) for c in cols]


def q_explode_outer(spark, sf_dir):
    flat = flatten_media(adapters.raw_media(_t(spark, sf_dir)))
    return flat.select("media_id", "media_name", "folder_name", "subfolder_name", "asset_type",
                       *_as_double(*ASSET_NUMBERS), MEDIA_ASSET_KEY)


def q_asset_key(spark, sf_dir):
    flat = flatten_media(adapters.raw_media(_t(spark, sf_dir)))
    one = dedup.distinct_on(flat, [MEDIA_ASSET_KEY], dedup.oldest_first("asset_file_size"))
    return one.select(MEDIA_ASSET_KEY, "media_id", *_as_double("asset_file_size"))


def q_channel_rule(spark, sf_dir):
    m = adapters.raw_media(_t(spark, sf_dir))
    return m.select(F.col("hashed_id").alias("media_id"), F.col("name").alias("title"),
                    channel_of("name").alias("channel"))


# --- filters and marks -----------------------------------------------------

def q_incremental_filter(spark, sf_dir):
    e = _t(spark, sf_dir).events
    return incremental.newer_than_mark(e, "ts", EVENTS_MARK) \
        .select("event_id", "ts", "user_id", "event_type")


def accept_input(t: Tables) -> DataFrame:
    """Events with text times in mixed spellings: missing (errors), junk
    (tiny values), '+05:00' offsets (views), 'Z' otherwise; and an empty key
    for large sign-ups."""
    e = t.events
    local5 = F.date_format(F.col("ts") + F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
            .when(F.col("value") < 1.0, F.lit("not a time"))
            .when(F.col("event_type") == "view", F.concat(local5, F.lit("+05:00")))
            .otherwise(iso_utc_string("ts")))
    key = F.when((F.col("event_type") == "signup") & (F.col("value") > 30), F.lit("")) \
        .otherwise(F.col("user_id").cast("string"))
    return e.select("event_id", text.alias("received_at"), key.alias("visitor_key"))


def q_accept_since(spark, sf_dir):
    acc = incremental.accept_since(accept_input(_t(spark, sf_dir)), "received_at", EVENTS_MARK,
                                   key_col="visitor_key", parsed_col="event_time")
    return acc.select("event_id", "visitor_key",
                      F.unix_micros(F.col("event_time").cast("timestamp")).alias("event_us"))


def q_entity_allow_list(spark, sf_dir):
    e = _t(spark, sf_dir).events
    return incremental.allow_list(e, "event_type", ALLOWED_EVENT_TYPES) \
        .select("event_id", "event_type", "user_id")


def q_advance_watermark(spark, sf_dir):
    e = _t(spark, sf_dir).events
    per_type = incremental.advance(e, "ts", ADVANCE_MARK, ["event_type"]) \
        .withColumnRenamed("event_type", "stream")
    nothing_new = incremental.advance(e, "ts", FUTURE_MARK).select(
        F.lit("all").alias("stream"), "*")
    return per_type.unionByName(nothing_new)


# --- windows and distinct --------------------------------------------------

def q_latest_per_key(spark, sf_dir):
    e = _t(spark, sf_dir).events
    return dedup.latest_per_key(e, ["user_id"], dedup.newest_first("ts", "event_id")) \
        .select("user_id", "event_id", "ts", "event_type")


def q_latest_nulls_last(spark, sf_dir):
    e = _t(spark, sf_dir).events
    nulled = e.withColumn("ts", F.when((F.col("event_type") == "error")
                                       | (F.pmod("user_id", F.lit(10)) == 0),
                                       F.lit(None)).otherwise(F.col("ts")))
    return dedup.latest_per_key(nulled, ["user_id"], dedup.newest_first("ts", "event_id")) \
        .select("user_id", "event_id", "ts")


def q_distinct_on(spark, sf_dir):
    e = _t(spark, sf_dir).events
    return dedup.distinct_on(e, ["user_id", "event_type"], dedup.oldest_first("event_id")) \
        .select("user_id", "event_type", "event_id", "value")


# --- upserts and joins -----------------------------------------------------

def q_upsert_all(spark, sf_dir):
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    changed = c.filter(F.col("c_mktsegment") == "BUILDING") \
        .withColumn("c_acctbal", F.col("c_acctbal") + F.lit(100.0))
    new = c.filter(F.col("c_mktsegment") == "MACHINERY").select(
        (F.col("c_custkey") + 1_000_000).alias("c_custkey"),
        F.concat(F.lit("New "), F.col("c_name")).alias("c_name"), "c_mktsegment", "c_acctbal")
    return upsert(c, changed.unionByName(new), ["c_custkey"])


def q_upsert_newer(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select("o_orderkey", "o_orderdate", "o_totalprice",
                                        "o_orderstatus")
    day = F.expr("INTERVAL 1 DAY")
    newer = o.filter(F.col("o_orderstatus") == "O").select(
        "o_orderkey", (F.col("o_orderdate") + day).alias("o_orderdate"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"), "o_orderstatus")
    older = o.filter(F.col("o_orderstatus") == "F").select(
        "o_orderkey", (F.col("o_orderdate") - day).alias("o_orderdate"),
        (F.col("o_totalprice") * 3).alias("o_totalprice"), "o_orderstatus")
    new = o.filter(F.col("o_orderstatus") == "P").withColumn(
        "o_orderkey", F.col("o_orderkey") + 10_000_000)
    return upsert(o, newer.unionByName(older).unionByName(new), ["o_orderkey"],
                  newer_than="o_orderdate")


def q_list_detail_lookup(spark, sf_dir):
    t = _t(spark, sf_dir)
    accepted = incremental.accept_since(adapters.visitor_list(t), "last_active_at",
                                        VISITOR_LIST_MARK, key_col="visitor_key")
    detail = flatten_visitor_detail(adapters.raw_visitor_detail(t))
    return accepted.join(detail.select("visitor_key", "visitor_name", "browser"),
                         on="visitor_key", how="inner") \
        .select("visitor_key", accepted["last_active_at"], "visitor_name", "browser")


# --- dimensions and facts --------------------------------------------------

def q_curated_dim_media(spark, sf_dir):
    return dim_media(_t(spark, sf_dir))


def q_gold_dim_media(spark, sf_dir):
    t = _t(spark, sf_dir)
    silver = flatten_media(adapters.raw_media_versions(t).withColumn(
        "ingestion_time", mark_literal(STAMP_TIME)))
    silver = dedup.distinct_on(silver, [MEDIA_ASSET_KEY],
                               dedup.newest_first(parse_iso("updated_at"))
                               + dedup.oldest_first("asset_file_size"))
    return model.gold_dim_media(silver)


def q_gold_dim_visitor(spark, sf_dir):
    t = _t(spark, sf_dir)
    raw = adapters.raw_visitor_detail(t).withColumn("ingestion_time", mark_literal(STAMP_TIME))
    return model.gold_dim_visitor(flatten_visitors(raw))


def q_curated_dim_visitor(spark, sf_dir):
    return model.curated_dim_visitor(silver_events(_t(spark, sf_dir)))


def q_fact_visitor_engagement(spark, sf_dir):
    return fact_events(_t(spark, sf_dir))


def q_fact_media_engagement(spark, sf_dir):
    return model.fact_media_engagement(adapters.media_summary(_t(spark, sf_dir)))


# --- KPIs ------------------------------------------------------------------

def q_visitors_by_media(spark, sf_dir):
    return kpi.distinct_visitors(fact_events(_t(spark, sf_dir), with_profile=False),
                                 ["media_id"], out="unique_visitors", drop_null_keys=True,
                                 order="key")


def q_visitors_by_browser(spark, sf_dir):
    return kpi.distinct_visitors(fact_events(_t(spark, sf_dir)), ["media_id", "browser"])


def q_visitors_by_channel(spark, sf_dir):
    t = _t(spark, sf_dir)
    return kpi.visitors_by_channel(fact_events(t, with_profile=False), dim_media(t))


def q_fact_event_versions(spark, sf_dir):
    """The fact over events that come in two versions: the newer one stays."""
    raw = adapters.raw_event_versions(_t(spark, sf_dir))
    return model.fact_visitor_engagement(flatten_events(raw))


def q_visitors_unmatched_media(spark, sf_dir):
    """Channels when the dimension lacks some media: their visitors count under NULL."""
    t = _t(spark, sf_dir)
    number = F.substring("media_id", 2, 20).cast("long")
    return kpi.visitors_by_channel(fact_events(t, with_profile=False),
                                   dim_media(t).where(number % 13 != 0))


def q_top_videos(spark, sf_dir):
    t = _t(spark, sf_dir)
    fact = model.fact_media_engagement(adapters.media_summary(t))
    return kpi.top_videos(fact, dim_media(t))


def q_kpi_totals(spark, sf_dir):
    return kpi.totals(fact_events(_t(spark, sf_dir), with_profile=False))


def q_preview(spark, sf_dir):
    return kpi.preview(fact_events(_t(spark, sf_dir)), ["event_key"], 100)


def q_sql_views(spark, sf_dir):
    """Dashboard path: named views + SQL, guarded by table and column presence."""
    t = _t(spark, sf_dir)
    catalog.register({"fact_visitor_engagement": fact_events(t, with_profile=False)})
    fact = catalog.table_or_none(spark, "fact_visitor_engagement")
    if fact is None or not {"media_id", "visitor_id"} <= set(fact.columns):
        raise LookupError("fact_visitor_engagement lacks a column that this query needs")
    return spark.sql("""
        SELECT media_id, CAST(COUNT(DISTINCT visitor_id) AS BIGINT) AS unique_visitors
        FROM fact_visitor_engagement
        WHERE media_id IS NOT NULL
        GROUP BY media_id""")


def q_numeric_measure(spark, sf_dir):
    t = _t(spark, sf_dir)
    top = kpi.top_videos(model.fact_media_engagement(adapters.media_summary(t)), dim_media(t))
    return kpi.chart_series(top, "media_id")


def q_schema_report(spark, sf_dir):
    rep = report.schema_report(adapters.raw_media(_t(spark, sf_dir)))
    return rep.select("column", "data_type", "non_null")


def q_ingest_stamp(spark, sf_dir):
    e = _t(spark, sf_dir).events
    return stamp(e, now=STAMP_TIME, base_name=True).select("event_id", "ingestion_time",
                                                           "source_file")


# --- writers and readers (files, snapshots, state, streams) -------------------

def q_sample_report(spark, sf_dir):
    """5 rows in key order written as JSON, read back with the schema."""
    fact = fact_events(_t(spark, sf_dir))
    path = fresh_dir(spark, "sample")
    write_json_sample(fact, path, ["event_key"], 5)
    return read_json(spark, path, fact.schema, multi_line=False)


def q_landing_roundtrip(spark, sf_dir):
    """Accepted raw events landed as partitioned JSON, read back with an
    explicit schema (K5, S1, S2)."""
    lake = jobs.Lake(spark, fresh_dir(spark, "landing"))
    jobs.land(lake, jobs.EVENTS, adapters.raw_events(_t(spark, sf_dir)))
    back = flatten_events(lake.read_raw(jobs.EVENTS), keep=[jobs.LANDING_PARTITION])
    return back.select("event_key", "received_at", "visitor_key", "media_id", "percent_viewed",
                       "browser", jobs.LANDING_PARTITION)


def q_parquet_roundtrip(spark, sf_dir):
    """Create a keyed table, upsert a batch into a new snapshot, save and
    read back the high-water mark (K1, K2, K3, S4, S5, K6, S7)."""
    t = _t(spark, sf_dir)
    root = fresh_dir(spark, "roundtrip")
    table = SnapshotTable(spark, f"{root}/fact")
    marks = WatermarkStore(spark, f"{root}/state")
    fact = fact_events(t)
    table.write(fact)
    changed = fact.filter(F.col("browser") == "BUILDING") \
        .withColumn("percent_viewed", F.col("percent_viewed") + F.lit(1.0))
    table.upsert(changed, ["event_key"])
    newest = table.read().agg(F.max(parse_iso("event_timestamp"))).first()[0]
    marks.save("fact_visitor_engagement", newest)
    mark = marks.get("fact_visitor_engagement", incremental.DEFAULT_LAYER_MARK)
    return table.read().select("event_key", "media_id", "visitor_id", "percent_viewed",
                               mark_literal(mark).alias("watermark"))


def q_stream_upsert(spark, sf_dir):
    """The events file as a stream (availableNow), latest row per visitor
    upserted into a snapshot table (T1, T2)."""
    t = _t(spark, sf_dir)
    stream = (spark.readStream.schema(t.events.schema)
              .option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir)
              .select("user_id", "event_id", "ts", "event_type"))
    table = SnapshotTable(spark, fresh_dir(spark, "stream_table"))
    upsert_stream(stream, table, ["user_id"], dedup.newest_first("ts", "event_id"),
                  checkpoint=fresh_dir(spark, "stream_ckpt"), newer_than="ts")
    return table.read()


def q_stream_bronze(spark, sf_dir):
    """Raw events landed as JSON, loaded into bronze by the file stream."""
    lake = jobs.Lake(spark, fresh_dir(spark, "stream_lake"))
    jobs.land(lake, jobs.EVENTS, adapters.raw_events(_t(spark, sf_dir)))
    jobs.raw_to_bronze_stream(lake, jobs.EVENTS)
    bronze = lake.table("bronze", "events").read()
    return bronze.select("event_key", "received_at", "visitor_key", "media_id",
                         F.col("user_agent_details.browser").alias("browser"))


INCREMENT_SPLIT = "2024-01-15T00:00:00Z"


def q_incremental_two_runs(spark, sf_dir):
    """Two incremental runs over the events: first those before the split,
    then all of them (the landing mark admits only the newer ones). The
    fact built from silver must equal the one-shot fact: nothing lost,
    nothing doubled (D0, D1, D4, F1, F2, K3, K6, S7)."""
    t = _t(spark, sf_dir)
    lake = jobs.Lake(spark, fresh_dir(spark, "two_runs"))
    raw = adapters.raw_event_versions(t)
    first = raw.filter(parse_iso("received_at") < mark_literal(INCREMENT_SPLIT))
    for i, part in enumerate([first, raw]):
        jobs.land(lake, jobs.EVENTS, part)
        jobs.raw_to_bronze(lake, now=f"2025-01-0{i + 1}T00:00:00Z", entities=[jobs.EVENTS])
        jobs.bronze_to_silver(lake)
    return model.fact_visitor_engagement(lake.table("silver", "events").read())


def q_medallion_end_to_end(spark, sf_dir):
    """All layers in one run: land raw JSON, bronze, silver, gold, refined,
    curated, KPIs; returns the channel KPI table (D0-D13)."""
    t = _t(spark, sf_dir)
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    jobs.run_parallel({
        "events": lambda: jobs.land(lake, jobs.EVENTS, adapters.raw_events(t)),
        "media": lambda: jobs.land(lake, jobs.MEDIA_METADATA, adapters.raw_media_versions(t)),
        "visitors": lambda: jobs.land_visitors(lake, adapters.visitor_list(t),
                                               adapters.raw_visitor_detail(t)),
        "summary": lambda: land_json(adapters.media_summary(t), lake.raw("media_summary")),
    })
    jobs.run_all(lake, now=STAMP_TIME)
    return lake.table("curated", "visitors_in_each_channel").read()


# --- per-layer row functions of the jobs (D1-D4, D7) -------------------------

def q_bronze_events(spark, sf_dir):
    """Raw event files holding an older copy of every click (stale browser)
    -> bronze rows: stamped, latest version per event key (D1)."""
    t = _t(spark, sf_dir)
    lake = jobs.Lake(spark, fresh_dir(spark, "bronze_lake"))
    raw = adapters.raw_events(t).withColumn(jobs.LANDING_PARTITION,
                                            F.substring("received_at", 1, 10))
    stale = (raw.filter(F.col("conversion_type") == "click")
             .withColumn("received_at", iso_utc_string(parse_iso("received_at")
                                                       - F.expr("INTERVAL 1 DAY")))
             .withColumn("user_agent_details",
                         F.col("user_agent_details").withField("browser", F.lit("STALE"))))
    land_json(raw, lake.raw("events"), partition_by=[jobs.LANDING_PARTITION])
    land_json(stale, lake.raw("events"), partition_by=[jobs.LANDING_PARTITION])
    bronze = jobs.bronze_batch(lake.read_raw(jobs.EVENTS), jobs.EVENTS, STAMP_TIME)
    return bronze.select("event_key", "received_at", "media_id",
                         F.col("user_agent_details.browser").alias("browser"),
                         "ingestion_time", jobs.RECORD_TIME)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_time", mark_literal(STAMP_TIME))


def q_silver_media(spark, sf_dir):
    rows = jobs.silver_media_rows(_stamped(adapters.raw_media_versions(_t(spark, sf_dir))))
    return rows.select(MEDIA_ASSET_KEY, "media_id", "media_name", "updated_at", "asset_type",
                       *_as_double(*ASSET_NUMBERS))


def q_silver_visitors(spark, sf_dir):
    return jobs.silver_visitor_rows(_stamped(adapters.raw_visitor_detail(_t(spark, sf_dir))))


def q_silver_events(spark, sf_dir):
    return jobs.silver_event_rows(_stamped(adapters.raw_event_versions(_t(spark, sf_dir))))


def q_refined_media_summary(spark, sf_dir):
    """Media summary landed as JSON, refined by the pass-through job."""
    lake = jobs.Lake(spark, fresh_dir(spark, "refine_lake"))
    land_json(adapters.media_summary(_t(spark, sf_dir)), lake.raw("media_summary"))
    jobs.refine(lake)
    return lake.table("refined", "media_summary").read()


# --- damaged, drifting and repeated input (S1, K3, T1, D0, D1) -----------------

def _raw_inputs(t: Tables) -> dict[str, tuple[DataFrame, F.Column]]:
    """Raw records of each entity, with the number that their key holds."""
    return {"events": (adapters.raw_events(t), F.col("event_key").cast("long")),
            "media_metadata": (adapters.raw_media(t), F.col("id")),
            "visitor_detail": (adapters.raw_visitor_detail(t), F.col("visitor_key").cast("long"))}


# A field of each entity that is no text, and the key.
_TYPED_FIELD = {"events": "percent_viewed", "media_metadata": "duration", "visitor_detail": "load_count"}
_KEYS = {e.name: e.key for e in jobs.ENTITIES}


def _damage(records: DataFrame, number: F.Column, entity: str) -> DataFrame:
    """JSON lines of the records: by the key's last digit, 3 is cut off, 4 has text
    in a number field, 5 lacks its key; all have a field that no schema declares."""
    digit = F.pmod(number, F.lit(10))
    key = _KEYS[entity]
    lines = records.withColumn("_digit", digit).withColumn("session_note", F.concat(F.lit("s"), number))
    lines = lines.withColumn(key, F.when(digit != 5, F.col(key)))
    whole = F.to_json(F.struct(*[c for c in lines.columns if c != "_digit"]))
    value = (F.when(F.col("_digit") == 3, F.substring(whole, 1, 20))
             .when(F.col("_digit") == 4, F.concat(F.lit(f'{{"{_TYPED_FIELD[entity]}":"n/a",'),
                                                  F.substring(whole, 2, 1 << 30)))
             .otherwise(whole))
    return lines.select(value.alias("value"))


def _damaged_lake(spark, sf_dir, name: str) -> jobs.Lake:
    lake = jobs.Lake(spark, fresh_dir(spark, name))
    for entity, (records, number) in _raw_inputs(_t(spark, sf_dir)).items():
        (_damage(records, number, entity).withColumn(jobs.LANDING_PARTITION, F.lit("2024-02-01"))
         .write.partitionBy(jobs.LANDING_PARTITION).text(lake.raw(entity)))
    return lake


def _fates(lake: jobs.Lake) -> DataFrame:
    """(entity, fate, n): bronze rows as good, quarantined records by reason."""
    parts = []
    for entity in _KEYS:
        good = lake.table("bronze", entity).read().agg(F.count("*").alias("n"))
        parts.append(good.select(F.lit(entity).alias("entity"), F.lit("good").alias("fate"), "n"))
        parts.append(lake.table("quarantine", entity).read().groupBy("reason")
                     .agg(F.sum("n_records").cast("long").alias("n"))
                     .select(F.lit(entity).alias("entity"), F.col("reason").alias("fate"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_quarantine_all(spark, sf_dir):
    """Two batch reloads over files with broken lines, badly typed fields and
    missing keys: good and rejected records are all records, counted once."""
    lake = _damaged_lake(spark, sf_dir, "damaged")
    for day in (1, 2):
        jobs.raw_to_bronze(lake, now=f"2025-01-0{day}T00:00:00Z")
    return _fates(lake)


def q_quarantine_stream(spark, sf_dir):
    """The same files through the stream, in two runs."""
    lake = _damaged_lake(spark, sf_dir, "damaged_stream")
    for _ in range(2):
        jobs.run_parallel({e.name: (lambda e=e: jobs.raw_to_bronze_stream(lake, e))
                           for e in jobs.ENTITIES})
    return _fates(lake)


def _bronze_of(spark, sf_dir, entity: jobs.Entity) -> DataFrame:
    lake = _damaged_lake(spark, sf_dir, f"bronze_{entity.name}")
    jobs.raw_to_bronze(lake, now=STAMP_TIME, entities=[entity])
    return lake.table("bronze", entity.name).read()


def q_bronze_media(spark, sf_dir):
    """Bronze media through the job; ``session_note`` is declared nowhere and comes
    from the kept record."""
    bronze = _bronze_of(spark, sf_dir, jobs.MEDIA_METADATA)
    return bronze.select("hashed_id", "name", "updated", F.size("assets").alias("n_assets"),
                         F.variant_get("record", "$.session_note", "string").alias("session_note"),
                         "ingestion_time")


def q_bronze_visitors(spark, sf_dir):
    bronze = _bronze_of(spark, sf_dir, jobs.VISITOR_DETAIL)
    return bronze.select("visitor_key", "load_count",
                         F.col("visitor_identity.name").alias("visitor_name"),
                         F.variant_get("record", "$.session_note", "string").alias("session_note"))


def q_rerun_is_noop(spark, sf_dir):
    """Two loads of the same raw events, some without a time and some in a
    five-digit year: the second commits nothing, and no event is lost."""
    t = _t(spark, sf_dir)
    lake = jobs.Lake(spark, fresh_dir(spark, "noop"))
    n = F.col("event_key").cast("long")
    odd = adapters.raw_events(t).withColumn(
        "received_at", F.when(n % 7 == 0, F.lit(None)).when(n % 11 == 0, F.lit("12024-01-01T00:00:00Z"))
        .otherwise(F.col("received_at")))
    land_json(odd.withColumn(jobs.LANDING_PARTITION, F.lit("2024-02-01")), lake.raw("events"),
              partition_by=[jobs.LANDING_PARTITION])
    for day in (1, 2):
        jobs.raw_to_bronze(lake, now=f"2025-01-0{day}T00:00:00Z", entities=[jobs.EVENTS])
    bronze = lake.table("bronze", "events")
    return bronze.read().agg(
        F.count("*").alias("events"),
        F.count_if(F.col(jobs.EVENT_DATE) == "unknown").alias("undated"),
        F.count_if(F.col(jobs.RECORD_TIME).isNull()).alias("without_time"),
        F.count_distinct(jobs.LOAD_ID).alias("commits"))


def q_land_visitors(spark, sf_dir):
    """Visitors landed by the list alone: details without a time land too, and
    listed visitors whose detail comes in the second run only are not lost."""
    t = _t(spark, sf_dir)
    lake = jobs.Lake(spark, fresh_dir(spark, "visitors"))
    number = F.col("visitor_key").cast("long")
    details = adapters.raw_visitor_detail(t).withColumn(
        "last_active_at", F.when(number % 2 == 0, F.col("last_active_at")))
    listed = adapters.visitor_list(t)
    jobs.land_visitors(lake, listed, details.where(number % 10 != 0))
    first = incremental.DEFAULT_INGEST_MARK
    mark = lake.marks.get("landing_visitor_detail", first)
    jobs.land_visitors(lake, listed.limit(0), details)
    return lake.read_raw(jobs.VISITOR_DETAIL).select(
        "visitor_key", "last_active_at", mark_literal(mark).alias("watermark"))


# --- loads, files and late records (F1, S1, S7, K3, K6, T2, D1-D6) --------------

# The event types of three loads, and the times that they claim.
LOADS = ((("click",), "2025-01-02T00:00:00Z"), (("view", "purchase"), "2025-01-02T00:00:00Z"),
         (("signup", "error"), "2025-01-01T00:00:00Z"))


def q_silver_after_late_load(spark, sf_dir):
    """Three bronze loads, the second with the first one's time and the third with an
    earlier one; silver runs after each and has every event in the end."""
    raw = adapters.raw_events(_t(spark, sf_dir))
    lake = jobs.Lake(spark, fresh_dir(spark, "late_load"))
    for types, now in LOADS:
        part = raw.where(F.col("conversion_type").isin(*types))
        land_json(part.withColumn(jobs.LANDING_PARTITION, F.lit("2024-02-01")), lake.raw("events"),
                  partition_by=[jobs.LANDING_PARTITION])
        jobs.raw_to_bronze(lake, now=now, entities=[jobs.EVENTS])
        jobs.bronze_to_silver(lake)
    return lake.table("silver", "events").read().select(
        "event_key", "received_at", "visitor_key", "media_id", "browser", "ingestion_time")


def q_bronze_reload_reads_new_files(spark, sf_dir):
    """Raw files are read once: a reload over unchanged raw reads none, one after another
    landing only what is new."""
    raw = adapters.raw_events(_t(spark, sf_dir))
    lake = jobs.Lake(spark, fresh_dir(spark, "reload"))
    early = parse_iso("received_at") < mark_literal(INCREMENT_SPLIT)
    read = []
    for part in (raw.where(early), raw.limit(0), raw.where(~early)):
        land_json(part.withColumn(jobs.LANDING_PARTITION, F.lit("2024-02-01")), lake.raw("events"),
                  partition_by=[jobs.LANDING_PARTITION])
        before = lake.read_files("bronze_events").read().count()
        n = jobs.raw_to_bronze(lake, now=STAMP_TIME, entities=[jobs.EVENTS])["events"]
        read.append((n, lake.read_files("bronze_events").read().count() - before))
    return lake.table("bronze", "events").read().groupBy(jobs.EVENT_DATE).agg(
        F.count("*").alias("events"), F.count_distinct(jobs.LOAD_ID).alias("loads")).select(
        "*", F.lit(read[1][0]).cast("long").alias("files_read_again"),
        F.lit(all(n == m for n, m in read)).alias("each_file_once"))


def q_upsert_far_versions(spark, sf_dir):
    """A second version of every click 40 days after the first, merged into the table by date:
    one row a key, wherever the first version lies. The batch is not broadcast, so the
    key bits choose the rows to shuffle (K3)."""
    e = _t(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")
    dated = lambda df: df.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    table = PartitionedTable(spark, fresh_dir(spark, "far"), "day")
    table.write(dated(e))
    later = e.where(F.col("event_type") == "click").select(
        "event_id", (F.col("ts") + F.expr("INTERVAL 40 DAYS")).alias("ts"), "user_id", "event_type",
        (F.col("value") * 2).alias("value"))
    table.upsert(dated(later), ["event_id"], newer_than="ts", broadcast=False)
    return table.read()


def q_late_records_land(spark, sf_dir):
    """Records that show up late: landing takes those of the window before its mark too,
    bronze ignores the ones that it has (T2)."""
    raw = adapters.raw_events(_t(spark, sf_dir))
    lake = jobs.Lake(spark, fresh_dir(spark, "late"), lateness=dt.timedelta(days=20))
    for part in (raw.where(parse_iso("received_at") >= mark_literal(INCREMENT_SPLIT)), raw):
        jobs.land(lake, jobs.EVENTS, part)
        jobs.raw_to_bronze(lake, now=STAMP_TIME, entities=[jobs.EVENTS])
    bronze = lake.table("bronze", "events").read()
    return bronze.select("event_key", "received_at", jobs.EVENT_DATE)


def q_scan_large(spark, sf_dir):
    return _t(spark, sf_dir).read("lineitem").select("*")


# --- tables as the jobs wrote them (D5-D9, D11-D15) --------------------------------

_lakes: dict[tuple[str, str], jobs.Lake] = {}


def _full_lake(spark: SparkSession, sf_dir: str) -> jobs.Lake:
    """All layers over one lake, loaded in two increments; built once an application."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _lakes:
        t = _t(spark, sf_dir)
        lake = jobs.Lake(spark, fresh_dir(spark, "full"))
        events, media = adapters.raw_event_versions(t), adapters.raw_media_versions(t)
        first_events = events.where(parse_iso("received_at") < mark_literal(INCREMENT_SPLIT))
        first_media = media.where(parse_iso("updated") < mark_literal("2024-02-15T00:00:00Z"))
        land_json(adapters.media_summary(t), lake.raw("media_summary"))
        jobs.land_visitors(lake, adapters.visitor_list(t), adapters.raw_visitor_detail(t))
        for e, m in ((first_events, first_media), (events, media)):
            jobs.land(lake, jobs.EVENTS, e)
            jobs.land(lake, jobs.MEDIA_METADATA, m)
            jobs.run_all(lake, now=STAMP_TIME)
            jobs.keep_visitor_counts(lake)
        _lakes[at] = lake
    return _lakes[at]


def q_job_gold_media(spark, sf_dir):
    return _full_lake(spark, sf_dir).table("gold", "dim_media").read().drop(jobs.LOAD_ID)


def q_job_gold_visitors(spark, sf_dir):
    return _full_lake(spark, sf_dir).table("gold", "dim_visitor").read().drop(jobs.LOAD_ID)


def q_job_silver_media(spark, sf_dir):
    rows = _full_lake(spark, sf_dir).table("silver", "media_metadata_flattened").read()
    return rows.select(MEDIA_ASSET_KEY, "media_id", "media_name", "updated_at", "asset_type",
                       *_as_double(*ASSET_NUMBERS))


def q_job_refined_visitors(spark, sf_dir):
    table = _full_lake(spark, sf_dir).table("refined", "visitor_detail_flattened")
    return table.read().drop("source_file")


def q_job_curated_media(spark, sf_dir):
    return _full_lake(spark, sf_dir).table("curated", "dim_media").read()


def q_job_fact(spark, sf_dir):
    return jobs.curated_fact(_full_lake(spark, sf_dir))


def q_job_dashboard(spark, sf_dir):
    """Every section of the dashboard page as rows: section, key, detail, value."""
    page = jobs.dashboard(_full_lake(spark, sf_dir))
    shapes = {"totals": None, "visitors_by_media": ("media_id", None, "unique_visitors"),
              "visitors_in_each_channel": ("channel", None, "number_of_visitors"),
              "visitors_in_each_browser": ("media_id", "browser", "number_of_visitors"),
              "top_videos": ("media_id", "channel", "play_count")}
    parts = []
    for section, shape in shapes.items():
        df = page[section]
        if shape is None:
            names = ["total_events", "unique_videos", "unique_visitors"]
            df = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value"))
                                               for n in names])).alias("x")).select("x.*")
            shape = ("key", None, "value")
        key, detail, value = shape
        parts.append(df.select(
            F.lit(section).alias("section"), F.col(key).alias("key"),
            (F.col(detail) if detail else F.lit(None).cast("string")).alias("detail"),
            F.col(value).cast("long").alias("value")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_visitors_by_media_kept(spark, sf_dir):
    """Distinct visitors a media from the kept bitmaps, after two increments (A1)."""
    bits = _full_lake(spark, sf_dir).table("curated", "visitor_bitmaps").read()
    return sketches.count_bitmaps(bits, ["media_id"])


def q_totals_kept(spark, sf_dir):
    """Distinct visitors over all media, from the same bitmaps."""
    return sketches.count_all(_full_lake(spark, sf_dir).table("curated", "visitor_bitmaps").read())


# Fixed value: five standard errors of a sketch.
SKETCH_BOUND = 5 * 1.04 / (1 << sketches.LOG_K) ** 0.5


def q_visitors_sketched(spark, sf_dir):
    """Visitors a media since a date, merged from daily sketches, against the exact count (A2)."""
    lake = _full_lake(spark, sf_dir)
    daily = lake.table("curated", "visitor_sketches").read()
    merged = sketches.merge_sketches(daily.where(F.col(jobs.EVENT_DATE) >= SKETCH_FROM), ["media_id"],
                                     out="estimate")
    fact = lake.table("curated", "fact_visitor_engagement").read()
    exact = kpi.distinct_visitors(fact.where(F.col(jobs.EVENT_DATE) >= SKETCH_FROM), ["media_id"],
                                  out="unique_visitors")
    off = F.abs(F.col("estimate") - F.col("unique_visitors"))
    return merged.join(exact, "media_id").select(
        "media_id", "events", "unique_visitors",
        (off <= F.lit(SKETCH_BOUND) * F.col("unique_visitors") + 1).alias("within_bound"))


def q_hot_key_join(spark, sf_dir):
    """Order lines with a third of all rows on one part, joined to the parts without a
    broadcast (J1, J3, J4): the hot part is dealt out, the others join plainly."""
    t = _t(spark, sf_dir)
    lines = t.read("lineitem")
    hot = F.when(F.pmod("l_orderkey", F.lit(3)) == 0, F.lit(1).cast(lines.schema["l_partkey"].dataType))
    lines = lines.withColumn("p_partkey", hot.otherwise(F.col("l_partkey")))
    joined = split_join(lines, t.part, "p_partkey", "left")
    return joined.groupBy("p_brand").agg(
        F.count("*").alias("lines"), F.count_distinct("p_partkey").alias("parts"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))


def q_schema_drift(spark, sf_dir):
    """Raw media with a field that nobody declared, at the top and inside a struct, and a number
    given as text in some records: one pass tells fields, kinds and counts (K7, D14)."""
    raw = adapters.raw_media(_t(spark, sf_dir)).drop("assets", "thumbnail", "subfolder")
    odd = F.pmod("id", F.lit(4)) == 0
    whole = raw.withColumn("added", F.when(odd, F.lit(True))).withColumn(
        "folder", F.col("folder").withField("owner", F.when(odd, F.lit("me"))))
    text = whole.withColumn("duration", F.lit("long"))
    lines = whole.where(~odd).select(F.to_json(F.struct("*")).alias("value")).unionByName(
        text.where(odd).select(F.to_json(F.struct("*")).alias("value")))
    lake = jobs.Lake(spark, fresh_dir(spark, "drift"))
    (lines.withColumn(jobs.LANDING_PARTITION, F.lit("2024-02-01")).write
     .partitionBy(jobs.LANDING_PARTITION).text(lake.raw("media_metadata")))
    return jobs.schema_test(lake)["media_metadata"].select(
        "column", "data_type", "inferred_type", "non_null", "state")


def q_pretty_json_split(spark, sf_dir):
    """All media documents in one pretty-printed array file, through bronze (S1): the file is
    read in splits, its records are those of JSON lines."""
    raw = adapters.raw_media(_t(spark, sf_dir))
    lake = jobs.Lake(spark, fresh_dir(spark, "pretty"), raw_multi_line=True)
    pretty = F.to_json(F.struct(*raw.columns), {"pretty": "true"})
    lead = F.when(F.col("id") == F.lit(raw.agg(F.min("id")).first()[0]), "[").otherwise(",")
    lines = raw.select("id", F.concat(lead, pretty).alias("value")).unionByName(
        raw.agg((F.max("id") + 1).alias("id")).select("id", F.lit("]").alias("value")))
    (lines.coalesce(1).sortWithinPartitions("id").select("value")
     .write.text(f"{lake.raw('media_metadata')}/{jobs.LANDING_PARTITION}=2024-02-01"))
    jobs.raw_to_bronze(lake, now=STAMP_TIME, entities=[jobs.MEDIA_METADATA])
    return lake.table("bronze", "media_metadata").read().select(
        "hashed_id", "name", "updated", F.col("folder.name").alias("folder_name"),
        F.coalesce(F.size("assets"), F.lit(-1)).alias("n_assets"))


# The date ranges of three files of a stream, in their order, and its delay.
STREAM_FILES = (("2024-01-10", "2024-01-20"), ("2024-01-01", "2024-01-10"), ("2024-01-20", "2024-03-01"))
STREAM_DELAY = dt.timedelta(days=12)


def q_stream_late_events(spark, sf_dir):
    """Events in three files out of order, some twice: what the watermark has passed goes to
    the side table, every other event is kept once (T1, T2)."""
    e = _t(spark, sf_dir).events.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type")
    path = fresh_dir(spark, "in_files")
    for at, (lo, hi) in enumerate(STREAM_FILES):
        part = e.where((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        twice = part.where(F.col("event_type") == "click")
        part.unionByName(twice).coalesce(1).write.parquet(f"{path}/file={at}")
    stream = (spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path)
              .select(*e.columns))
    kept = PartitionedTable(spark, fresh_dir(spark, "kept"), "event_date")
    late = AppendTable(spark, fresh_dir(spark, "late_events"))
    keep_in_time(stream, "event_id", "ts", STREAM_DELAY, kept, late, fresh_dir(spark, "late_ckpt"))
    fates = kept.read().select(F.lit("kept").alias("fate"), "event_date").unionByName(
        late.read().select(F.lit("late").alias("fate"), F.date_format("ts", "yyyy-MM-dd").alias("event_date")))
    return fates.groupBy("fate", "event_date").agg(F.count("*").alias("n"))


QUERIES: dict[str, Query] = {
    "visitors_by_media_kept": q_visitors_by_media_kept,
    "totals_kept": q_totals_kept,
    "visitors_sketched": q_visitors_sketched,
    "hot_key_join": q_hot_key_join,
    "schema_drift": q_schema_drift,
    "stream_late_events": q_stream_late_events,
    "pretty_json_split": q_pretty_json_split,
    "silver_after_late_load": q_silver_after_late_load,
    "bronze_reload_reads_new_files": q_bronze_reload_reads_new_files,
    "upsert_far_versions": q_upsert_far_versions,
    "late_records_land": q_late_records_land,
    "scan_large": q_scan_large,
    "job_gold_media": q_job_gold_media,
    "job_gold_visitors": q_job_gold_visitors,
    "job_silver_media": q_job_silver_media,
    "job_refined_visitors": q_job_refined_visitors,
    "job_curated_media": q_job_curated_media,
    "job_fact": q_job_fact,
    "job_dashboard": q_job_dashboard,
    "quarantine_all": q_quarantine_all,
    "quarantine_stream": q_quarantine_stream,
    "bronze_media": q_bronze_media,
    "bronze_visitors": q_bronze_visitors,
    "rerun_is_noop": q_rerun_is_noop,
    "fact_event_versions": q_fact_event_versions,
    "visitors_unmatched_media": q_visitors_unmatched_media,
    "land_visitors": q_land_visitors,
    "scan_all": q_scan_all,
    "project_rename": q_project_rename,
    "nested_access": q_nested_access,
    "explode_outer": q_explode_outer,
    "asset_key": q_asset_key,
    "channel_rule": q_channel_rule,
    "incremental_filter": q_incremental_filter,
    "accept_since": q_accept_since,
    "entity_allow_list": q_entity_allow_list,
    "advance_watermark": q_advance_watermark,
    "latest_per_key": q_latest_per_key,
    "latest_nulls_last": q_latest_nulls_last,
    "distinct_on": q_distinct_on,
    "upsert_all": q_upsert_all,
    "upsert_newer": q_upsert_newer,
    "list_detail_lookup": q_list_detail_lookup,
    "curated_dim_media": q_curated_dim_media,
    "gold_dim_media": q_gold_dim_media,
    "gold_dim_visitor": q_gold_dim_visitor,
    "curated_dim_visitor": q_curated_dim_visitor,
    "fact_visitor_engagement": q_fact_visitor_engagement,
    "fact_media_engagement": q_fact_media_engagement,
    "visitors_by_media": q_visitors_by_media,
    "visitors_by_browser": q_visitors_by_browser,
    "visitors_by_channel": q_visitors_by_channel,
    "top_videos": q_top_videos,
    "kpi_totals": q_kpi_totals,
    "preview": q_preview,
    "sql_views": q_sql_views,
    "numeric_measure": q_numeric_measure,
    "schema_report": q_schema_report,
    "ingest_stamp": q_ingest_stamp,
    "sample_report": q_sample_report,
    "landing_roundtrip": q_landing_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "stream_upsert": q_stream_upsert,
    "stream_bronze": q_stream_bronze,
    "medallion_end_to_end": q_medallion_end_to_end,
    "incremental_two_runs": q_incremental_two_runs,
    "bronze_events": q_bronze_events,
    "silver_media": q_silver_media,
    "silver_visitors": q_silver_visitors,
    "silver_events": q_silver_events,
    "refined_media_summary": q_refined_media_summary,
}
