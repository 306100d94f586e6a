"""DuckDB SQL equivalent of each registered query (the correctness oracle).

Written independently of the Spark code: plain joins, GROUP BY and
``row_number`` over the driver's tables (pre-registered as views).
"""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"

# Events with visitor geo/browser, flattened (the silver events columns used).
EV = f"""ev AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_key,
         strftime(e.ts, {ISO}) AS received_at,
         e.ts, e.user_id, e.event_type,
         CAST(e.user_id AS VARCHAR) AS visitor_key,
         '10.' || CAST(c.c_nationkey AS VARCHAR) || '.' || CAST(e.user_id % 256 AS VARCHAR) AS ip,
         n.n_name AS country,
         CAST(n.n_regionkey AS VARCHAR) AS region,
         n.n_name || '-' || CAST(e.user_id % 5 AS VARCHAR) AS city,
         CAST(c.c_nationkey AS DOUBLE) AS lat,
         CAST(n.n_regionkey AS DOUBLE) AS lon,
         c.c_mktsegment AS org,
         lower(c.c_name) || '@example.com' AS email,
         'm' || json_extract_string(e.props, '$.k') AS media_id,
         'Media ' || json_extract_string(e.props, '$.k') AS media_name,
         e.value AS percent_viewed,
         'https://embed.example/m' || json_extract_string(e.props, '$.k') AS embed_url,
         c.c_mktsegment AS browser,
         CASE WHEN e.user_id % 2 = 0 THEN 'Windows' ELSE 'iOS' END AS platform,
         e.user_id % 2 = 1 AS is_mobile
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

FACT = f"""{EV},
fact AS (
  SELECT event_key, media_id, visitor_key AS visitor_id, received_at AS event_timestamp,
         percent_viewed, browser, country, embed_url
  FROM ev)"""

TITLE = """CASE p_partkey % 8
      WHEN 0 THEN p_name || ' on Facebook'
      WHEN 1 THEN upper('FB ' || p_name || ' yt')
      WHEN 2 THEN p_name || ' - YouTube cut'
      WHEN 3 THEN 'yt ' || p_name
      WHEN 4 THEN p_name || ' bytes'
      WHEN 5 THEN NULL
      WHEN 6 THEN ''
      ELSE p_name END"""


def channel(col: str) -> str:
    c = f"lower({col})"
    return (f"CASE WHEN contains({c}, 'facebook') THEN 'Facebook' "
            f"WHEN contains({c}, 'fb') THEN 'Facebook' "
            f"WHEN contains({c}, 'youtube') THEN 'YouTube' "
            f"WHEN contains({c}, 'yt') THEN 'YouTube' ELSE 'Unknown' END")


MEDIA = f"""media AS (
  SELECT p_partkey, p_size, p_type, p_brand, p_retailprice,
         'm' || CAST(p_partkey AS VARCHAR) AS media_id,
         {TITLE} AS title,
         p_type AS folder_name,
         CASE WHEN p_size % 2 = 0 THEN NULL ELSE lower(p_type) END AS subfolder_name
  FROM part)"""

ASSETS = """assets AS (
  SELECT m.p_partkey, r.i,
         CASE WHEN r.i = 0 THEN 'original' ELSE 'mp4' END AS asset_type,
         CASE WHEN r.i = 2 AND m.p_size % 3 = 0 THEN NULL
              ELSE CAST(m.p_size AS BIGINT) * (16 * (r.i + 1)) END AS asset_width,
         CASE WHEN r.i = 1 AND m.p_size % 3 = 0 THEN NULL
              WHEN r.i = 2 AND m.p_size % 3 = 0 THEN CAST(m.p_size AS BIGINT) * 32
              ELSE CAST(m.p_size AS BIGINT) * (9 * (r.i + 1)) END AS asset_height,
         m.p_partkey * 1000 + r.i AS asset_file_size
  FROM media m
  JOIN (SELECT range AS i FROM range(0, 3)) r
    ON m.p_size % 5 <> 0 AND r.i < m.p_size % 4)"""

FLAT_MEDIA = f"""{MEDIA},
{ASSETS},
flat AS (
  SELECT m.media_id, m.title AS media_name, m.folder_name, m.subfolder_name,
         a.asset_type, a.asset_width, a.asset_height, a.asset_file_size,
         concat_ws('_', m.media_id, a.asset_type, a.asset_width, a.asset_height) AS media_asset_key
  FROM media m LEFT JOIN assets a ON m.p_partkey = a.p_partkey)"""

# Latest media document: the re-cut version where it exists (p_size > 25).
LATEST_MEDIA = f"""{MEDIA},
latest AS (
  SELECT media_id, p_partkey, p_size, p_type, p_retailprice,
         CASE WHEN p_size > 25 THEN concat_ws(' ', title, '(re-cut)') ELSE title END AS title,
         CASE WHEN p_size > 25
              THEN '2024-03-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || 'T08:30:00+02:00'
              ELSE '2024-02-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || 'T12:00:00Z'
         END AS updated_at,
         '2024-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS created_at
  FROM media),
dim AS (
  SELECT media_id, title, 'https://img.example/' || media_id || '.jpg' AS url,
         {channel('title')} AS channel, created_at
  FROM latest)"""

MEDIA_FACT = """mfact AS (
  SELECT 'm' || CAST(k AS VARCHAR) AS media_id,
         count(*) AS load_count,
         count(*) FILTER (WHERE event_type = 'view') AS play_count,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS play_rate,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / 60.0 AS total_hours_watched,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS average_engagement,
         count(DISTINCT user_id) AS unique_visitors
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
  GROUP BY k)"""

ACT = """act AS (
  SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts,
         arg_max(event_id, ts) AS last_event_id,
         count(*) AS load_count,
         count(*) FILTER (WHERE event_type = 'view') AS play_count
  FROM events GROUP BY user_id)"""

VISITOR = f"""{ACT},
visitor AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS visitor_key,
         strftime(a.first_ts, {ISO}) AS created_at,
         strftime(a.last_ts, {ISO}) AS last_active_at,
         CAST(a.last_event_id AS VARCHAR) AS last_event_key,
         a.load_count, a.play_count,
         c.c_name AS visitor_name,
         lower(c.c_name) || '@example.com' AS visitor_email,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 'Org ' || CAST(c.c_nationkey AS VARCHAR) END AS org_name,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_mktsegment END AS org_title,
         c.c_mktsegment AS browser,
         CAST(c.c_nationkey AS VARCHAR) AS browser_version,
         CASE WHEN c.c_custkey % 2 = 1 THEN 'iOS' ELSE 'Windows' END AS platform,
         c.c_custkey % 2 = 1 AS mobile
  FROM customer c LEFT JOIN act a ON c.c_custkey = a.user_id)"""

STAMP = "TIMESTAMP '2025-01-01 00:00:00'"

SCHEMA_ROWS = [
    ("id", "bigint", "count(p_partkey)"),
    ("hashed_id", "string", "count(p_partkey)"),
    ("name", "string", f"count({TITLE})"),
    ("duration", "double", "count(p_retailprice)"),
    ("created", "string", "count(p_size)"),
    ("updated", "string", "count(p_partkey)"),
    ("status", "string", "count(*)"),
    ("folder.id", "bigint", "count(p_size)"),
    ("folder.hashed_id", "string", "count(p_brand)"),
    ("folder.name", "string", "count(p_type)"),
    ("subfolder.hashed_id", "string", "count(CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_brand END)"),
    ("subfolder.name", "string", "count(CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_type END)"),
    ("thumbnail.url", "string", "count(p_partkey)"),
    ("thumbnail.width", "bigint", "count(p_size)"),
    ("thumbnail.height", "bigint", "count(p_size)"),
    ("assets", "array<struct<width:bigint,height:bigint,type:string,file_size:bigint,"
               "content_type:string,url:string>>",
     "count(CASE WHEN p_size % 5 = 0 THEN NULL ELSE 1 END)"),
]

LATEST_PER_USER = """
SELECT user_id, event_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
                               event_id DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1"""

# Records of the damaged inputs by what becomes of them.
FATES = f"""WITH {VISITOR},
keys AS (
  SELECT 'events' AS entity, event_id AS k FROM events
  UNION ALL SELECT 'media_metadata', p_partkey FROM part
  UNION ALL SELECT 'visitor_detail', CAST(visitor_key AS BIGINT) FROM visitor)
SELECT entity, CASE WHEN k % 10 IN (3, 4) THEN 'malformed' WHEN k % 10 = 5 THEN 'missing_key'
                    ELSE 'good' END AS fate, count(*) AS n
FROM keys GROUP BY ALL"""

GOLD_MEDIA = f"""WITH {LATEST_MEDIA}
SELECT media_id, title, 'https://img.example/' || media_id || '.jpg' AS thumbnail_url,
       p_retailprice AS duration, 'ready' AS status, p_type AS folder_name,
       CASE WHEN p_size % 2 = 0 THEN NULL ELSE lower(p_type) END AS subfolder_name,
       {channel('title')} AS channel, created_at, updated_at, {STAMP} AS ingestion_time
FROM latest"""

GOLD_VISITOR = f"""WITH {VISITOR}
SELECT visitor_key, visitor_name, visitor_email, org_title AS visitor_title,
       org_name AS organization_name, created_at, last_active_at, browser, browser_version,
       platform, mobile AS is_mobile, {STAMP} AS ingestion_time
FROM visitor"""

SILVER_MEDIA = f"""WITH {LATEST_MEDIA},
{ASSETS},
flat AS (
  SELECT l.media_id, l.title AS media_name, l.updated_at, a.asset_type, a.asset_width,
         a.asset_height, a.asset_file_size,
         concat_ws('_', l.media_id, a.asset_type, a.asset_width, a.asset_height) AS media_asset_key
  FROM latest l LEFT JOIN assets a ON l.p_partkey = a.p_partkey)
SELECT media_asset_key, media_id, media_name, updated_at, asset_type,
       CAST(asset_width AS DOUBLE) AS asset_width, CAST(asset_height AS DOUBLE) AS asset_height,
       CAST(asset_file_size AS DOUBLE) AS asset_file_size
FROM (SELECT *, row_number() OVER (PARTITION BY media_asset_key
                                   ORDER BY asset_file_size ASC NULLS LAST) AS rn FROM flat)
WHERE rn = 1"""

SQL: dict[str, str] = {
    "quarantine_all": FATES,

    "quarantine_stream": FATES,

    "bronze_media": f"""
SELECT 'm' || CAST(p_partkey AS VARCHAR) AS hashed_id, {TITLE} AS name,
       '2024-02-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || 'T12:00:00Z' AS updated,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(least(p_size % 4, 3) AS INTEGER) END AS n_assets,
       's' || CAST(p_partkey AS VARCHAR) AS session_note, {STAMP} AS ingestion_time
FROM part WHERE p_partkey % 10 NOT IN (3, 4, 5)""",

    "bronze_visitors": f"""WITH {VISITOR}
SELECT visitor_key, load_count, visitor_name, 's' || visitor_key AS session_note
FROM visitor WHERE CAST(visitor_key AS BIGINT) % 10 NOT IN (3, 4, 5)""",

    "rerun_is_noop": """
SELECT count(*) AS events, count(*) FILTER (event_id % 7 = 0 OR event_id % 11 = 0) AS undated,
       count(*) FILTER (event_id % 7 = 0 OR event_id % 11 = 0) AS without_time, CAST(1 AS BIGINT) AS commits
FROM events""",

    "fact_event_versions": f"WITH {FACT} SELECT * FROM fact",

    "visitors_unmatched_media": f"""WITH {FACT}, {LATEST_MEDIA}
SELECT d.channel, count(DISTINCT f.visitor_id) AS number_of_visitors
FROM fact f LEFT JOIN dim d ON f.media_id = d.media_id
                           AND CAST(substr(d.media_id, 2) AS BIGINT) % 13 <> 0
GROUP BY d.channel""",

    "land_visitors": f"""WITH {VISITOR}
SELECT visitor_key, CASE WHEN CAST(visitor_key AS BIGINT) % 2 = 0 THEN last_active_at END AS last_active_at,
       (SELECT max(ts) FROM events) AS watermark
FROM visitor WHERE load_count IS NOT NULL""",

    "scan_all": "SELECT * FROM nation",

    "scan_large": "SELECT * FROM lineitem",

    "visitors_by_media_kept": f"""WITH {FACT}
SELECT media_id, count(DISTINCT visitor_id) AS unique_visitors FROM fact GROUP BY media_id""",

    "totals_kept": "SELECT count(DISTINCT user_id) AS unique_visitors FROM events",

    "visitors_sketched": f"""WITH {FACT}
SELECT media_id, count(*) AS events, count(DISTINCT visitor_id) AS unique_visitors, true AS within_bound
FROM fact WHERE event_timestamp >= '2024-01-10' GROUP BY media_id""",

    "hot_key_join": """
SELECT p_brand, count(*) AS lines, count(DISTINCT l.p_partkey) AS parts,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS p_partkey FROM lineitem) l
LEFT JOIN part p ON l.p_partkey = p.p_partkey GROUP BY p_brand""",

    "schema_drift": f"""WITH {MEDIA},
d AS (SELECT *, p_partkey % 4 = 0 AS odd FROM media),
leaf AS (
  SELECT 'id' AS "column", 'bigint' AS data_type, 'bigint' AS inferred_type, true AS here, 'as declared' AS state FROM d
  UNION ALL SELECT 'hashed_id', 'string', 'string', true, 'as declared' FROM d
  UNION ALL SELECT 'name', 'string', 'string', title IS NOT NULL, 'as declared' FROM d
  UNION ALL SELECT 'duration', 'double', 'double|string', true, 'retyped' FROM d
  UNION ALL SELECT 'created', 'string', 'string', true, 'as declared' FROM d
  UNION ALL SELECT 'updated', 'string', 'string', true, 'as declared' FROM d
  UNION ALL SELECT 'status', 'string', 'string', true, 'as declared' FROM d
  UNION ALL SELECT 'folder.id', 'bigint', 'bigint', true, 'as declared' FROM d
  UNION ALL SELECT 'folder.hashed_id', 'string', 'string', true, 'as declared' FROM d
  UNION ALL SELECT 'folder.name', 'string', 'string', true, 'as declared' FROM d
  UNION ALL SELECT 'folder.owner', NULL, 'string', odd, 'extra' FROM d
  UNION ALL SELECT 'added', NULL, 'boolean', odd, 'extra' FROM d)
SELECT "column", data_type, inferred_type, count(*) AS non_null, state FROM leaf WHERE here GROUP BY ALL
UNION ALL
SELECT c, t, NULL, 0, 'absent' FROM (VALUES ('subfolder.hashed_id', 'string'), ('subfolder.name', 'string'),
  ('thumbnail.url', 'string'), ('thumbnail.width', 'bigint'), ('thumbnail.height', 'bigint'),
  ('assets', 'array<struct<width:bigint,height:bigint,type:string,file_size:bigint,content_type:string,url:string>>')
  ) AS absent (c, t)""",

    "pretty_json_split": f"""
SELECT 'm' || CAST(p_partkey AS VARCHAR) AS hashed_id, {TITLE} AS name,
       '2024-02-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || 'T12:00:00Z' AS updated,
       p_type AS folder_name,
       CASE WHEN p_size % 5 = 0 THEN -1 ELSE CAST(least(p_size % 4, 3) AS INTEGER) END AS n_assets
FROM part""",

    "stream_late_events": """
WITH e AS (SELECT *, ts < (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20') - INTERVAL 12 DAY
                     AND ts < TIMESTAMP '2024-01-10' AS late FROM events)
SELECT CASE WHEN late THEN 'late' ELSE 'kept' END AS fate, strftime(ts, '%Y-%m-%d') AS event_date,
       CAST(sum(CASE WHEN late AND event_type = 'click' THEN 2 ELSE 1 END) AS BIGINT) AS n
FROM e GROUP BY ALL""",

    "silver_after_late_load": f"""WITH {EV}
SELECT event_key, received_at, visitor_key, media_id, browser,
       CASE WHEN event_type IN ('signup', 'error') THEN TIMESTAMP '2025-01-01 00:00:00'
            ELSE TIMESTAMP '2025-01-02 00:00:00' END AS ingestion_time
FROM ev""",

    "bronze_reload_reads_new_files": """
SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS events, CAST(1 AS BIGINT) AS loads,
       CAST(0 AS BIGINT) AS files_read_again, true AS each_file_once
FROM events GROUP BY 1""",

    "upsert_far_versions": """
SELECT event_id, user_id, event_type,
       CASE WHEN event_type = 'click' THEN value * 2 ELSE value END AS value,
       CASE WHEN event_type = 'click' THEN ts + INTERVAL 40 DAY ELSE ts END AS ts,
       strftime(CASE WHEN event_type = 'click' THEN ts + INTERVAL 40 DAY ELSE ts END, '%Y-%m-%d') AS day
FROM events""",

    "late_records_land": f"""WITH {EV}
SELECT event_key, received_at, strftime(ts, '%Y-%m-%d') AS event_date FROM ev
WHERE ts >= TIMESTAMP '2024-01-15' OR ts > (SELECT max(ts) FROM events) - INTERVAL 20 DAY""",

    "job_gold_media": GOLD_MEDIA,

    "job_gold_visitors": f"{GOLD_VISITOR} WHERE load_count IS NOT NULL",

    "job_silver_media": SILVER_MEDIA,

    "job_refined_visitors": f"WITH {VISITOR} SELECT * FROM visitor WHERE load_count IS NOT NULL",

    "job_curated_media": f"WITH {LATEST_MEDIA} SELECT * FROM dim",

    "job_fact": f"WITH {FACT} SELECT * FROM fact",

    "job_dashboard": f"""WITH {FACT}, {LATEST_MEDIA}, {MEDIA_FACT}
SELECT 'totals' AS section, 'total_events' AS key, CAST(NULL AS VARCHAR) AS detail, count(*) AS value FROM fact
UNION ALL SELECT 'totals', 'unique_videos', NULL, count(DISTINCT media_id) FROM fact
UNION ALL SELECT 'totals', 'unique_visitors', NULL, count(DISTINCT visitor_id) FROM fact
UNION ALL SELECT 'visitors_by_media', media_id, NULL, count(DISTINCT visitor_id) FROM fact
  WHERE media_id IS NOT NULL GROUP BY media_id
UNION ALL SELECT 'visitors_in_each_channel', d.channel, NULL, count(DISTINCT f.visitor_id)
  FROM fact f LEFT JOIN dim d ON f.media_id = d.media_id GROUP BY d.channel
UNION ALL SELECT 'visitors_in_each_browser', media_id, browser, count(DISTINCT visitor_id) FROM fact
  GROUP BY media_id, browser
UNION ALL SELECT 'top_videos', f.media_id, d.channel, f.play_count
  FROM mfact f JOIN dim d ON f.media_id = d.media_id""",

    "project_rename": """
SELECT c_custkey AS visitor_id, c_name AS visitor_name, c_mktsegment AS browser,
       c_nationkey AS country_id, c_acctbal AS balance
FROM customer""",

    "nested_access": f"WITH {VISITOR} SELECT * FROM visitor",

    "explode_outer": f"""WITH {FLAT_MEDIA}
SELECT media_id, media_name, folder_name, subfolder_name, asset_type,
       CAST(asset_width AS DOUBLE) AS asset_width, CAST(asset_height AS DOUBLE) AS asset_height,
       CAST(asset_file_size AS DOUBLE) AS asset_file_size, media_asset_key
FROM flat""",

    "asset_key": f"""WITH {FLAT_MEDIA}
SELECT media_asset_key, media_id, CAST(asset_file_size AS DOUBLE) AS asset_file_size FROM (
  SELECT *, row_number() OVER (PARTITION BY media_asset_key
                               ORDER BY asset_file_size ASC NULLS LAST) AS rn
  FROM flat) WHERE rn = 1""",

    "channel_rule": f"WITH {MEDIA} SELECT media_id, title, {channel('title')} AS channel FROM media",

    "incremental_filter": """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",

    "accept_since": """
SELECT event_id, CAST(user_id AS VARCHAR) AS visitor_key, epoch_us(ts) AS event_us
FROM events
WHERE event_type <> 'error' AND value >= 1.0
  AND ts > TIMESTAMP '2024-01-15 00:00:00'
  AND NOT (event_type = 'signup' AND value > 30)""",

    "entity_allow_list": """
SELECT event_id, event_type, user_id FROM events WHERE event_type IN ('view', 'purchase')""",

    "advance_watermark": """
SELECT event_type AS stream,
       TIMESTAMP '2024-01-20 00:00:00' AS previous_mark,
       coalesce(max(ts) FILTER (WHERE ts > TIMESTAMP '2024-01-20 00:00:00'),
                TIMESTAMP '2024-01-20 00:00:00') AS new_mark,
       count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-20 00:00:00') AS accepted,
       count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-20 00:00:00') > 0 AS has_new
FROM events GROUP BY event_type
UNION ALL
SELECT 'all', TIMESTAMP '2100-01-01 00:00:00',
       coalesce(max(ts) FILTER (WHERE ts > TIMESTAMP '2100-01-01 00:00:00'),
                TIMESTAMP '2100-01-01 00:00:00'),
       count(*) FILTER (WHERE ts > TIMESTAMP '2100-01-01 00:00:00'),
       count(*) FILTER (WHERE ts > TIMESTAMP '2100-01-01 00:00:00') > 0
FROM events""",

    "latest_per_key": LATEST_PER_USER,

    "stream_upsert": LATEST_PER_USER,

    "latest_nulls_last": """
WITH e AS (
  SELECT user_id, event_id,
         CASE WHEN event_type = 'error' OR user_id % 10 = 0 THEN NULL ELSE ts END AS ts
  FROM events)
SELECT user_id, event_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
                               event_id DESC) AS rn
  FROM e) WHERE rn = 1""",

    "distinct_on": """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn
  FROM events) WHERE rn = 1""",

    "upsert_all": """
WITH base AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer),
batch AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal + 100.0 AS c_acctbal
  FROM base WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT c_custkey + 1000000, 'New ' || c_name, c_mktsegment, c_acctbal
  FROM base WHERE c_mktsegment = 'MACHINERY')
SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM batch s WHERE s.c_custkey = b.c_custkey)
UNION ALL SELECT * FROM batch""",

    "upsert_newer": """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderstatus
FROM orders
UNION ALL
SELECT o_orderkey + 10000000, o_orderdate, o_totalprice, o_orderstatus
FROM orders WHERE o_orderstatus = 'P'""",

    "list_detail_lookup": f"""
WITH a AS (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id)
SELECT CAST(a.user_id AS VARCHAR) AS visitor_key, strftime(a.last_ts, {ISO}) AS last_active_at,
       c.c_name AS visitor_name, c.c_mktsegment AS browser
FROM a JOIN customer c ON c.c_custkey = a.user_id
WHERE a.last_ts > TIMESTAMP '2024-01-29 00:00:00'""",

    "curated_dim_media": f"WITH {LATEST_MEDIA} SELECT * FROM dim",

    "gold_dim_media": GOLD_MEDIA,

    "gold_dim_visitor": GOLD_VISITOR,

    "curated_dim_visitor": f"""WITH {EV}
SELECT DISTINCT visitor_key AS visitor_id, ip AS ip_address, country, region, city, browser,
       platform, is_mobile
FROM ev""",

    "fact_visitor_engagement": f"WITH {FACT} SELECT * FROM fact",

    "incremental_two_runs": f"WITH {FACT} SELECT * FROM fact",

    "fact_media_engagement": f"WITH {MEDIA_FACT} SELECT * FROM mfact",

    "visitors_by_media": f"""WITH {FACT}
SELECT media_id, count(DISTINCT visitor_id) AS unique_visitors
FROM fact WHERE media_id IS NOT NULL GROUP BY media_id""",

    "visitors_by_browser": f"""WITH {FACT}
SELECT media_id, browser, count(DISTINCT visitor_id) AS number_of_visitors
FROM fact GROUP BY media_id, browser""",

    "visitors_by_channel": f"""WITH {FACT}, {LATEST_MEDIA}
SELECT d.channel, count(DISTINCT f.visitor_id) AS number_of_visitors
FROM fact f LEFT JOIN dim d ON f.media_id = d.media_id
GROUP BY d.channel""",

    "top_videos": f"""WITH {MEDIA_FACT}, {LATEST_MEDIA}
SELECT f.media_id, d.title, d.channel, f.total_hours_watched, f.play_count
FROM mfact f JOIN dim d ON f.media_id = d.media_id
ORDER BY f.play_count DESC, f.media_id""",

    "kpi_totals": f"""WITH {FACT}
SELECT count(*) AS total_events, count(DISTINCT media_id) AS unique_videos,
       count(DISTINCT visitor_id) AS unique_visitors
FROM fact""",

    "preview": f"WITH {FACT} SELECT * FROM fact ORDER BY event_key LIMIT 100",

    "sql_views": f"""WITH {FACT}
SELECT media_id, count(DISTINCT visitor_id) AS unique_visitors
FROM fact WHERE media_id IS NOT NULL GROUP BY media_id""",

    "numeric_measure": f"""WITH {MEDIA_FACT}, {LATEST_MEDIA}
SELECT f.media_id, f.total_hours_watched
FROM mfact f JOIN dim d ON f.media_id = d.media_id""",

    "schema_report": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS data_type, {expr} AS non_null FROM part"
        for c, t, expr in SCHEMA_ROWS),

    "sample_report": f"WITH {FACT} SELECT * FROM fact ORDER BY event_key LIMIT 5",

    "landing_roundtrip": f"""WITH {EV}
SELECT event_key, received_at, visitor_key, media_id, percent_viewed, browser,
       strftime(ts, '%Y-%m-%d') AS landed_date
FROM ev""",

    "parquet_roundtrip": f"""WITH {FACT}
SELECT event_key, media_id, visitor_id,
       CASE WHEN browser = 'BUILDING' THEN percent_viewed + 1.0 ELSE percent_viewed END
         AS percent_viewed,
       (SELECT max(ts) FROM events) AS watermark
FROM fact""",

    "stream_bronze": f"""WITH {EV}
SELECT event_key, received_at, visitor_key, media_id, browser FROM ev""",

    "medallion_end_to_end": f"""WITH {FACT}, {LATEST_MEDIA}
SELECT d.channel, count(DISTINCT f.visitor_id) AS number_of_visitors
FROM fact f LEFT JOIN dim d ON f.media_id = d.media_id
GROUP BY d.channel""",

    "bronze_events": f"""WITH {EV}
SELECT event_key, received_at, media_id, browser, {STAMP} AS ingestion_time,
       ts AS record_time
FROM ev""",

    "silver_media": SILVER_MEDIA,

    "silver_visitors": f"""WITH {VISITOR}
SELECT visitor_key, created_at, last_active_at, last_event_key, load_count, play_count,
       visitor_name, visitor_email, org_title AS visitor_title, org_name AS organization_name,
       browser, browser_version, platform, mobile AS is_mobile, {STAMP} AS ingestion_time
FROM visitor""",

    "silver_events": f"""WITH {EV}
SELECT event_key, received_at, visitor_key, ip, country, region, city, lat, lon, org, email,
       media_id, media_name, percent_viewed, event_type AS conversion_type, embed_url,
       browser, platform, is_mobile, {STAMP} AS ingestion_time,
       strftime(ts, '%Y-%m-%d') AS event_date
FROM ev""",

    "refined_media_summary": f"""WITH {MEDIA_FACT}
SELECT media_id, load_count, play_count, play_rate, total_hours_watched AS hours_watched,
       average_engagement AS engagement, unique_visitors AS visitors
FROM mfact""",

    "ingest_stamp": f"""
SELECT event_id, {STAMP} AS ingestion_time, 'events.parquet' AS source_file FROM events""",
}
