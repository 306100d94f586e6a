"""The layer jobs: landing -> bronze -> silver -> gold / curated -> KPI.

Every upsert is idempotent, so any job can be re-run after a failure. Each load
marks its rows with a ``load_id`` of its own, and a ledger names the loads that a
job has consumed. Incremental jobs follow one shape:

    todo = loads of the source that the ledger lacks   # F1, S7: anti-join, no clock
    (n, newest) = observed while todo is written       # F5 guard, A3
    transform, dedup per key, upsert rows of todo      # W1/A8, K3
    ledger.append(todo), marks.save(name, newest)      # K6, only after the write
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.time import parse_iso, to_utc_naive
from tidemark.operators import dedup, incremental, kpi, model, sketches
from tidemark.operators.flatten import (MEDIA_ASSET_KEY, flatten_events, flatten_media,
                                        flatten_visitor_detail, flatten_visitors)
from tidemark.operators.stamp import source_file, stamp
from tidemark.operators.joins import sized_broadcast
from tidemark.operators.upsert import materialize, staged
from tidemark.sinks import land_json
from tidemark.sources import append, catalog
from tidemark.sources.append import AppendTable
from tidemark.sources.files import (CORRUPT_COLUMN, RECORD_COLUMN, list_children, list_files,
                                    parse_records, path_exists, read_json, read_text_records,
                                    text_schema)
from tidemark.sources.partitioned import PartitionedTable
from tidemark.sources.snapshots import SnapshotTable
from tidemark.sources.state import WatermarkStore


@dataclass(frozen=True)
class Entity:
    """A raw input: schema, key, the text time that orders its versions."""
    name: str
    schema: object
    key: str
    time_col: str


# The three ingested entities (key and version-order column).
VISITOR_DETAIL = Entity("visitor_detail", schemas.VISITOR_DETAIL, "visitor_key", "last_active_at")
MEDIA_METADATA = Entity("media_metadata", schemas.MEDIA_METADATA, "hashed_id", "updated")
EVENTS = Entity("events", schemas.EVENT, "event_key", "received_at")
ENTITIES = (VISITOR_DETAIL, MEDIA_METADATA, EVENTS)

RECORD_TIME = "record_time"
LANDING_PARTITION = "landed_date"
EVENT_DATE = "event_date"

LOAD_ID = "load_id"

# The large, append-mostly tables, partitioned by event date so
# an incremental upsert rewrites only the dates it touches.
PARTITIONED_TABLES = {("bronze", "events"): EVENT_DATE, ("silver", "events"): EVENT_DATE,
                      ("curated", "fact_visitor_engagement"): EVENT_DATE,
                      ("curated", "visitor_sketches"): EVENT_DATE}


def new_load_id() -> str:
    """A name for one load, unlike any other's: loads are told apart, never ordered."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def run_parallel(tasks: dict) -> dict:
    """Run independent steps (name -> no-arg callable) as concurrent Spark
    jobs from driver threads; the first error is raised. Each step's jobs
    are small next to the cluster, so running them side by side fills idle
    executors instead of queueing."""
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}


def event_date(time: str | F.Column) -> F.Column:
    """Partition value: UTC date of a parsed time, ``unknown`` when NULL."""
    t = F.col(time) if isinstance(time, str) else time
    return F.coalesce(F.date_format(t, "yyyy-MM-dd"), F.lit("unknown"))


# Tables that only grow.
GROWING_TABLES = {("refined", "visitor_detail_flattened"), ("state", "visitor_numbers")}

LAYERS = ("bronze", "silver", "gold", "refined", "curated", "quarantine", "state")

# Raw folder layouts. "landed" is ours (JSON lines by landing
# date: splittable, prunable); "by_key" is the API poller's layout
# (pretty-printed files under one folder per media / visitor / page).
RAW_PARTITIONS = {
    "landed": {"visitor_detail": (LANDING_PARTITION,), "media_metadata": (LANDING_PARTITION,),
               "events": (LANDING_PARTITION,)},
    "by_key": {"visitor_detail": ("visitor_key",), "media_metadata": ("media_id",),
               "events": ("page",)},
}


class Lake:
    """Folder layout of one deployment (any Hadoop file system).

    ``raw_layout="by_key"`` with ``raw_multi_line=True`` reads raw folders as
    the API poller writes them; the default reads our JSON-lines landing.
    """

    def __init__(self, spark: SparkSession, root: str, raw_multi_line: bool = False,
                 raw_layout: str = "landed", lateness: dt.timedelta | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.raw_multi_line = raw_multi_line
        self.raw_layout = raw_layout
        self.lateness = lateness     # landing takes records of this window before its mark too
        self.marks = WatermarkStore(spark, f"{self.root}/state/watermarks")

    def raw_partitions(self, entity_name: str) -> tuple[str, ...]:
        return RAW_PARTITIONS[self.raw_layout].get(entity_name, ())

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def table(self, layer: str, name: str) -> Table:
        path = f"{self.root}/{layer}/{name}"
        if layer == "quarantine" or (layer, name) in GROWING_TABLES:
            return AppendTable(self.spark, path)
        col = PARTITIONED_TABLES.get((layer, name))
        return PartitionedTable(self.spark, path, col) if col else SnapshotTable(self.spark, path)

    def read_files(self, job: str) -> AppendTable:
        """Ledger of the raw files that a job has read."""
        return AppendTable(self.spark, f"{self.root}/state/read_files/{job}", append.FILES)

    def read_loads(self, job: str) -> AppendTable:
        """Ledger of the loads, by part of the source table, that a job has consumed."""
        return AppendTable(self.spark, f"{self.root}/state/read_loads/{job}", append.LOADS)

    def tables(self) -> list[tuple[str, str]]:
        """(layer, name) of every table that a job has written."""
        found = [(layer, name) for layer in LAYERS
                 for name in list_children(self.spark, f"{self.root}/{layer}")]
        ledgers = {("state", n) for n in ("watermarks", "read_files", "read_loads")}
        return sorted(t for t in found if t not in ledgers and self.table(*t).exists())

    def new_files(self, name: str, job: str) -> list:
        """Raw files that the job has not read as they are now: new ones, and those whose size
        or time changed. The paths of one load's files, as any reader lists them."""
        unread = self.read_files(job).unread(list_files(self.spark, self.raw(name)),
                                             append.FILES.fieldNames())
        return unread.collect()

    def mark_read(self, job: str, files: list) -> None:
        self.read_files(job).append(self.spark.createDataFrame(files, append.FILES))

    def read_records(self, name: str, schema, partition_columns: Sequence[str] = (),
                     files: list | None = None) -> DataFrame:
        """Raw records, parsed once; see :func:`parse_records`."""
        paths = None if files is None else [f["path"] for f in files]
        return parse_records(read_text_records(self.spark, self.raw(name), self.raw_multi_line,
                                               tuple(partition_columns), paths), schema)

    def read_raw(self, entity: Entity, partition_columns: Sequence[str] | None = None,
                 keep_corrupt: bool = False):
        cols = self.raw_partitions(entity.name) if partition_columns is None else partition_columns
        return read_json(self.spark, self.raw(entity.name), entity.schema,
                         multi_line=self.raw_multi_line, partition_columns=tuple(cols),
                         keep_corrupt=keep_corrupt)


# --- D0: landing ------------------------------------------------------------

def land(lake: Lake, entity: Entity, records: DataFrame, allowed: Sequence[str] | None = None,
         allow_col: str | None = None) -> int:
    """Land records newer than the entity's mark as JSON lines under
    ``landed_date=`` folders; then advance the mark (floored at the old one) from
    exactly the landed records. Returns the number landed.

    With ``lake.lateness``, records of that window before the mark land too; bronze
    ignores those it has. Visitors need a key; other records without one go on and
    end in bronze's quarantine, where they are counted.
    """
    mark_name = f"landing_{entity.name}"
    mark = lake.marks.get(mark_name, incremental.DEFAULT_INGEST_MARK)
    acc = incremental.accept_since(records, entity.time_col, _overlap(lake, mark),
                                   key_col=entity.key if entity is VISITOR_DETAIL else None,
                                   parsed_col="_t")
    if allowed is not None:
        acc = incremental.allow_list(acc, allow_col or entity.key, allowed)
    seen = Observation()
    _land_rows(lake, entity, acc, seen)
    n, newest = seen.get["n"], seen.get["newest"]
    if n:
        lake.marks.save(mark_name, max(to_utc_naive(mark), newest))
    return n


def _overlap(lake: Lake, mark: dt.datetime) -> dt.datetime:
    return to_utc_naive(mark) - lake.lateness if lake.lateness else mark


def _land_rows(lake: Lake, entity: Entity, rows: DataFrame, seen: Observation) -> None:
    """Lands ``rows``; their number and newest time are observed by the write itself."""
    land_json(rows.withColumn(LANDING_PARTITION, event_date("_t")), lake.raw(entity.name),
              partition_by=[LANDING_PARTITION], drop=["_t"],
              observe=(seen, F.count(F.lit(1)).alias("n"), F.max("_t").alias("newest")))


def land_visitors(lake: Lake, visitor_list: DataFrame, details: DataFrame) -> int:
    """List -> detail lookup (J3): land the detail of each accepted visitor.

    The list alone decides: its times select visitors and move the mark, and a
    detail lands as it is, whatever time it holds. Listed visitors without a detail
    wait in ``state/pending_visitor_detail`` and are looked up again by later runs.
    """
    mark_name = f"landing_{VISITOR_DETAIL.name}"
    mark = lake.marks.get(mark_name, incremental.DEFAULT_INGEST_MARK)
    acc = incremental.accept_since(visitor_list, "last_active_at", _overlap(lake, mark),
                                   key_col="visitor_key", parsed_col="_t")
    listed = materialize(acc.groupBy("visitor_key").agg(F.max("_t").alias("_t")))
    n_listed, newest = incremental.batch_stats(listed, "_t")
    pending = lake.table("state", "pending_visitor_detail")
    waiting = pending.exists()
    wanted = listed
    if waiting:
        wanted = (listed.unionByName(pending.read()).groupBy("visitor_key")
                  .agg(F.max("_t").alias("_t")))
    with staged(details.join(wanted, on="visitor_key", how="inner")) as picked:
        seen = Observation()
        _land_rows(lake, VISITOR_DETAIL, picked, seen)
        n = seen.get["n"]
        missing = materialize(wanted.join(picked.select("visitor_key"), "visitor_key", "left_anti"))
    if waiting or not missing.isEmpty():
        pending.write(missing)
    if n_listed:
        lake.marks.save(mark_name, max(to_utc_naive(mark), newest))
    return n


# --- D1: raw -> bronze ------------------------------------------------------

def bronze_batch(raw: DataFrame, entity: Entity, now: dt.datetime | str,
                 latest=dedup.latest_per_key) -> DataFrame:
    """Stamped raw rows, latest per key (newest time, then newest ingestion,
    then newest file), with the parsed ``record_time``. For stored rows, ``latest`` may be
    :func:`tidemark.operators.dedup.latest_of_few`; so too in the silver functions."""
    stamped = stamp(raw, now=now).withColumn(RECORD_TIME, parse_iso(entity.time_col))
    stamped = stamped.filter(F.col(entity.key).isNotNull())
    if entity is EVENTS:
        stamped = stamped.withColumn(EVENT_DATE, event_date(RECORD_TIME))
    return latest(stamped, [entity.key],
                  dedup.newest_first(RECORD_TIME, "ingestion_time", "source_file"))


def split_records(records: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected records) of parsed raw records. Together they are all
    of them: a record is rejected as ``malformed`` if it is no JSON object or any
    declared field has another type, and as ``missing_key`` without its key."""
    told = records.withColumn("reason", _reason(key))
    good = told.where(F.col("reason").isNull()).drop("reason", CORRUPT_COLUMN)
    text = F.coalesce(F.col(CORRUPT_COLUMN), F.to_json(RECORD_COLUMN))
    return good, told.where(F.col("reason").isNotNull()).select(
        "source_file", text.alias(CORRUPT_COLUMN), "reason")


def _reason(key: str) -> F.Column:
    return (F.when(F.col(CORRUPT_COLUMN).isNotNull(), "malformed")
            .when(F.col(key).isNull(), "missing_key"))


def add_rejected(lake: Lake, name: str, rejected: DataFrame, now: dt.datetime | str) -> None:
    """Append rejected records to ``quarantine/<name>``, one row a text and file with
    the number of its records. What the table has is not added again, so a replayed
    load changes nothing; what it has is never rewritten."""
    same = ["source_file", CORRUPT_COLUMN, "reason"]
    table = lake.table("quarantine", name)
    rows = rejected.groupBy(*same).agg(F.count("*").alias("n_records"))
    table.append(stamp(table.unread(rows, same), now=now))


@contextmanager
def parsed_once(lake: Lake, name: str, schema, key: str, files: list | None = None,
                partition_columns: Sequence[str] = ()) -> Iterator[tuple[DataFrame, DataFrame, int]]:
    """(good rows, rejected records, number of these) of raw files, for the block. They are parsed
    once, into shared storage; the rejected are counted on the way, so nobody looks for them in
    vain."""
    seen = Observation()
    records = lake.read_records(name, schema, partition_columns, files)
    records = records.observe(seen, F.count(_reason(key)).alias("rejected"))
    with staged(records) as stored:
        yield *split_records(stored, key), seen.get["rejected"]


def raw_to_bronze(lake: Lake, now: dt.datetime | str | None = None,
                  entities: Sequence[Entity] = ENTITIES, quarantine: bool = True) -> dict[str, int]:
    """Load raw files that bronze has not read as they are now; returns how many, by entity.

    A ledger of files (path, size, time) is anti-joined with the listing, so a load
    over unchanged raw reads none. A key is replaced only by a strictly newer record, so
    unchanged rows keep their load and ingestion time. Bronze keeps each whole record as
    a VARIANT next to the declared fields. With ``quarantine`` (default), rejected records
    are added to ``quarantine/<entity>``. The files are marked read at the end: after a
    crash they are read again, which changes nothing."""
    now = now or dt.datetime.now(dt.timezone.utc)

    def load(e: Entity) -> int:
        job = f"bronze_{e.name}"
        files = lake.new_files(e.name, job)
        if files:
            with parsed_once(lake, e.name, e.schema, e.key, files,
                             lake.raw_partitions(e.name)) as (good, rejected, n_rejected):
                if quarantine and n_rejected:
                    add_rejected(lake, e.name, rejected, now)
                batch = bronze_batch(good, e, now, dedup.latest_of_few).withColumn(LOAD_ID, F.lit(new_load_id()))
                lake.table("bronze", e.name).upsert(batch, [e.key], newer_than=RECORD_TIME)
            lake.mark_read(job, files)
        return len(files)

    present = [e for e in entities if path_exists(lake.spark, lake.raw(e.name))]
    return run_parallel({e.name: (lambda e=e: load(e)) for e in present})


# --- D2-D6: incremental layer jobs -------------------------------------------

Table = SnapshotTable | PartitionedTable | AppendTable


def _unread(lake: Lake, job: str, source: Table) -> tuple[int, DataFrame | None, DataFrame | None, dt.datetime | None]:
    """(rows, the rows, the loads they come from, newest ingestion) that the job has not consumed.

    A row is unread if its load, in its part of the table, is not in the job's ledger: neither
    clocks nor the order of commits matter. Only the columns that tell are read of the
    whole source, and rows only of the parts that hold something unread. A load that
    commits part by part is consumed part by part.
    """
    if not source.exists():
        return 0, None, None, None
    rows = source.read()
    part = F.col(source.col) if isinstance(source, PartitionedTable) else F.lit("")
    seen = Observation()
    found = rows.groupBy(LOAD_ID, part.alias("part")).agg(
        F.count("*").alias("n"), F.max("ingestion_time").alias("newest"))
    todo = materialize(lake.read_loads(job).unread(found, [LOAD_ID, "part"]).observe(
        seen, F.sum("n").alias("n"), F.max("newest").alias("newest")))
    # the join prunes the source to the parts in question when it is planned or run
    wanted = sized_broadcast(todo.select(F.col(LOAD_ID).alias("_load"), F.col("part").alias("_part")))
    batch = rows.join(wanted, (F.col(LOAD_ID) == F.col("_load")) & (part == F.col("_part")), "left_semi")
    return seen.get["n"] or 0, batch, todo, seen.get["newest"]


def _consumed(lake: Lake, job: str, todo: DataFrame, newest: dt.datetime | None) -> None:
    """The job is done with these loads; its mark, which tells how far it came, never goes back."""
    def mark() -> None:
        before = lake.marks.get(job, incremental.DEFAULT_LAYER_MARK)
        lake.marks.save(job, max(before, newest or before))

    run_parallel({"loads": lambda: lake.read_loads(job).append(todo), "mark": mark})


def _incremental(lake: Lake, job: str, source: Table, target: Table, transform, key: str) -> int:
    """Upsert into ``target`` what the job has not consumed of ``source``; returns how many rows."""
    n, batch, todo, newest = _unread(lake, job, source)
    if n:
        target.upsert(transform(batch).withColumn(LOAD_ID, F.lit(new_load_id())), [key])
        _consumed(lake, job, todo, newest)
    return n


def silver_media_rows(bronze: DataFrame) -> DataFrame:
    flat = flatten_media(bronze)
    return dedup.distinct_on(flat, [MEDIA_ASSET_KEY],
                             dedup.newest_first(parse_iso("updated_at"), "ingestion_time")
                             + dedup.oldest_first("asset_file_size"))


def silver_visitor_rows(bronze: DataFrame, latest=dedup.latest_per_key) -> DataFrame:
    return latest(flatten_visitors(bronze), ["visitor_key"],
                  dedup.newest_first(parse_iso("last_active_at"), "ingestion_time"))


def silver_event_rows(bronze: DataFrame, latest=dedup.latest_per_key) -> DataFrame:
    rows = latest(flatten_events(bronze), ["event_key"],
                  dedup.newest_first(parse_iso("received_at"), "ingestion_time"))
    return rows.withColumn(EVENT_DATE, event_date(parse_iso("received_at")))


def bronze_to_silver(lake: Lake) -> dict[str, int]:
    """The three silver jobs (independent: run side by side)."""
    return run_parallel({
        "media_metadata_flattened": lambda: _incremental(
            lake, "silver_media", lake.table("bronze", "media_metadata"),
            lake.table("silver", "media_metadata_flattened"), silver_media_rows, MEDIA_ASSET_KEY),
        "visitor_list": lambda: _incremental(
            lake, "silver_visitors", lake.table("bronze", "visitor_detail"),
            lake.table("silver", "visitor_list"),
            lambda rows: silver_visitor_rows(rows, dedup.latest_of_few), "visitor_key"),
        "events": lambda: _incremental(
            lake, "silver_events", lake.table("bronze", "events"),
            lake.table("silver", "events"),
            lambda rows: silver_event_rows(rows, dedup.latest_of_few), "event_key"),
    })


def silver_to_gold(lake: Lake) -> dict[str, int]:
    """The two gold dimension jobs (independent: run side by side)."""
    return run_parallel({
        "dim_media": lambda: _incremental(
            lake, "gold_dim_media", lake.table("silver", "media_metadata_flattened"),
            lake.table("gold", "dim_media"), model.gold_dim_media, "media_id"),
        "dim_visitor": lambda: _incremental(
            lake, "gold_dim_visitor", lake.table("silver", "visitor_list"),
            lake.table("gold", "dim_visitor"), model.gold_dim_visitor, "visitor_key"),
    })


# --- D7-D11: full-refresh layers --------------------------------------------

def refine(lake: Lake) -> None:
    """Refined media summary (pass-through, rebuilt) and visitor detail: every good raw
    record flattened, versions too. Raw files are never rewritten rows, so the latter
    only grows by the files not read yet."""
    def summary() -> None:
        with parsed_once(lake, "media_summary", schemas.MEDIA_SUMMARY, "media_id") as (good, rejected, n):
            if n:
                add_rejected(lake, "media_summary", rejected, dt.datetime.now(dt.timezone.utc))
            lake.table("refined", "media_summary").write(good.drop(RECORD_COLUMN, "source_file"))

    def visitor_detail() -> None:
        job = "refined_visitor_detail"
        files = lake.new_files(VISITOR_DETAIL.name, job)
        if not files:
            return
        records = lake.read_records(VISITOR_DETAIL.name, VISITOR_DETAIL.schema,
                                    lake.raw_partitions(VISITOR_DETAIL.name), files)
        flat = flatten_visitor_detail(records.where(F.col(CORRUPT_COLUMN).isNull()),
                                      keep=["source_file"])
        table = lake.table("refined", "visitor_detail_flattened")
        table.append(table.unread(flat, ["source_file"]))       # a file's rows go in once
        lake.mark_read(job, files)

    steps = {"media_summary": summary, VISITOR_DETAIL.name: visitor_detail}
    run_parallel({name: step for name, step in steps.items()
                  if path_exists(lake.spark, lake.raw(name))})


UPKEEP = ("ingestion_time", EVENT_DATE)      # columns that jobs go by and reports do not show


def curate(lake: Lake) -> None:
    """curated dims and facts, from bronze, silver and refined tables only (each skipped when
    its source does not exist yet; independent tables are built side by side). The visitor
    fact takes only what is new in silver, which holds one row a key already."""
    tasks = {}
    media = lake.table("bronze", MEDIA_METADATA.name)
    if media.exists():
        tasks["dim_media"] = lambda: lake.table("curated", "dim_media").write(
            model.curated_dim_media(media.read()))
    silver_events = lake.table("silver", "events")
    if silver_events.exists():
        tasks["dim_visitor"] = lambda: lake.table("curated", "dim_visitor").write(
            model.curated_dim_visitor(silver_events.read()))
        tasks["fact_visitor_engagement"] = lambda: _incremental(
            lake, "curated_fact_visitor_engagement", silver_events,
            lake.table("curated", "fact_visitor_engagement"),
            lambda rows: model.visitor_engagement_rows(rows, keep=UPKEEP), "event_key")
    summary = lake.table("refined", "media_summary")
    if summary.exists():
        tasks["fact_media_engagement"] = lambda: lake.table(
            "curated", "fact_media_engagement").write(model.fact_media_engagement(summary.read()))
    run_parallel(tasks)


def curated_fact(lake: Lake) -> DataFrame:
    """The visitor engagement fact, without the columns that only its upkeep needs."""
    return lake.table("curated", "fact_visitor_engagement").read().drop(LOAD_ID, *UPKEEP)


# --- D12, D13: KPIs ----------------------------------------------------------

def build_kpis(lake: Lake) -> None:
    """KPI tables, built side by side; each is skipped while its inputs do
    not exist yet."""
    fact_t, dim_t = lake.table("curated", "fact_visitor_engagement"), lake.table("curated", "dim_media")
    fme = lake.table("curated", "fact_media_engagement")
    has_fact, has_dim, has_fme = fact_t.exists(), dim_t.exists(), fme.exists()
    tasks = {}
    if has_fact:
        tasks["visitors_in_each_browser"] = lambda: lake.table(
            "curated", "visitors_in_each_browser").write(
            kpi.distinct_visitors(curated_fact(lake), ["media_id", "browser"]))
        tasks["visitors_by_media"] = lambda: lake.table("curated", "visitors_by_media").write(
            kpi.distinct_visitors(curated_fact(lake), ["media_id"], out="unique_visitors",
                                  drop_null_keys=True, order="key"))
        if has_dim:
            tasks["visitors_in_each_channel"] = lambda: lake.table(
                "curated", "visitors_in_each_channel").write(
                kpi.visitors_by_channel(curated_fact(lake), dim_t.read()))
    if has_fme and has_dim:
        tasks["top_videos"] = lambda: lake.table("curated", "top_videos").write(
            kpi.top_videos(fme.read(), dim_t.read()))
    run_parallel(tasks)


# --- distinct visitors that are kept up (A1, A2, A7) ----------------------------

def keep_visitor_counts(lake: Lake) -> int:
    """Bring the kept distinct counts up to the curated fact; returns the events counted.

    ``curated/visitor_bitmaps``: one bitmap a media and block of visitor numbers, grown by the
    loads not counted yet. Exact as long as later versions of an event keep its media
    and visitor: a bit is never taken back.
    ``curated/visitor_sketches``: sketches a date and media, made anew for the dates whose files
    changed, so they follow every change of the fact.
    """
    fact = lake.table("curated", "fact_visitor_engagement")
    n, batch, todo, newest = _unread(lake, "visitor_bitmaps", fact)
    if n:
        numbers = lake.table("state", "visitor_numbers")
        known = numbers.read() if numbers.exists() else None
        numbers.append(sketches.number_new(known, batch, "visitor_id"))
        bits = sketches.visitor_bitmaps(batch, numbers.read(), ["media_id"])
        table = lake.table("curated", "visitor_bitmaps")
        old = table.read() if table.exists() else None
        table.write(sketches.merge_bitmaps(old, bits, ["media_id"]))
        _consumed(lake, "visitor_bitmaps", todo, newest)
        _refresh_sketches(lake, fact)
    return n


def _refresh_sketches(lake: Lake, fact: PartitionedTable) -> None:
    job = "visitor_sketches"
    files = lake.read_files(job).unread(list_files(lake.spark, fact.path), append.FILES.fieldNames())
    files = materialize(files)
    date = F.regexp_extract("path", f"{fact.col}=([^/]+)/", 1)
    dates = sorted(r[0] for r in files.select(date).distinct().collect())
    table = lake.table("curated", "visitor_sketches")
    if dates:
        table.write(sketches.visitor_sketches(fact.read(dates), fact.col, ["media_id"]))
        lake.read_files(job).append(files)
    table.drop(sorted(set(table.partitions()) - set(fact.partitions())))


# The tables the dashboard reads.
DASHBOARD_TABLES = ("fact_visitor_engagement", "visitors_in_each_channel",
                    "visitors_in_each_browser", "top_videos")


def register_dashboard(lake: Lake) -> list[str]:
    """Expose the curated KPI tables that exist as views."""
    present = {}
    for name in DASHBOARD_TABLES:
        t = lake.table("curated", name)
        if t.exists():
            present[name] = curated_fact(lake) if isinstance(t, PartitionedTable) else t.read()
    catalog.register(present)
    return list(present)


def run_all(lake: Lake, now: dt.datetime | str | None = None) -> None:
    """All layers; what does not wait for each other runs side by side."""
    raw_to_bronze(lake, now=now)
    run_parallel({"silver": lambda: bronze_to_silver(lake), "refined": lambda: refine(lake)})

    def curated() -> None:
        curate(lake)
        build_kpis(lake)

    run_parallel({"gold": lambda: silver_to_gold(lake), "curated": curated})


# --- T1: raw -> bronze as a stream -------------------------------------------

def raw_to_bronze_stream(lake: Lake, entity: Entity, checkpoint: str | None = None,
                         max_files_per_trigger: int | None = None):
    """Incremental bronze load: only raw files not seen before are read.

    Each micro-batch is stamped with one driver-side time (a literal, so a
    retried task stamps the same value) and upserted with the strictly-newer
    rule, so replaying a micro-batch or landing a late, older version of a
    key changes nothing.
    """
    from tidemark.streaming.incremental import upsert_stream

    parts = tuple(lake.raw_partitions(entity.name))
    reader = lake.spark.readStream.schema(text_schema(parts))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = (reader.text(lake.raw(entity.name), wholetext=lake.raw_multi_line)
              .withColumn("source_file", source_file()))

    def prepare(batch: DataFrame, epoch: int) -> DataFrame:
        now = dt.datetime.now(dt.timezone.utc)
        good, rejected = split_records(materialize(parse_records(batch, entity.schema)), entity.key)
        if not rejected.isEmpty():
            add_rejected(lake, entity.name, rejected, now)
        out = (stamp(good, now=now).withColumn(RECORD_TIME, parse_iso(entity.time_col))
               .withColumn(LOAD_ID, F.lit(new_load_id())))
        return out.withColumn(EVENT_DATE, event_date(RECORD_TIME)) if entity is EVENTS else out

    return upsert_stream(stream, lake.table("bronze", entity.name), [entity.key],
                         dedup.newest_first(RECORD_TIME, "ingestion_time", "source_file"),
                         checkpoint or f"{lake.root}/_streams/bronze_{entity.name}",
                         prepare=prepare, newer_than=RECORD_TIME)


# --- D14: schema test of the raw folders --------------------------------------

# The raw folders the schema test covers, with their schemas.
SCHEMA_TEST_FOLDERS = {
    "visitor_list": schemas.VISITOR_LIST,
    "media_summary": schemas.MEDIA_SUMMARY,
    "visitor_detail": schemas.VISITOR_DETAIL,
    "media_metadata": schemas.MEDIA_METADATA,
    "events": schemas.EVENT,
    "media_engagement": None,        # its fields are not declared: inference alone
}


def schema_test(lake: Lake, sample_rows: int = 5) -> dict[str, DataFrame]:
    """For each raw folder present: a drift report, and a ``sample_rows`` JSON sample in
    key order under ``test-output/<name>``. Returns the reports.

    A report has one row a field: ``column, data_type`` (declared), ``declared, inferred_type``
    (the kinds of value found, NULL if none), ``non_null, state`` (as declared, retyped, extra or
    absent). It is one aggregation over all records as VARIANT
    (:func:`tidemark.operators.report.drift_report`). The sample has the fields declared,
    or those that the merged schema of all records has where none are declared.
    """
    from tidemark.operators.report import by_field, drift_report
    from tidemark.sinks import write_json_sample

    out = {}
    for name, schema in SCHEMA_TEST_FOLDERS.items():
        if not path_exists(lake.spark, lake.raw(name)):
            continue
        records = lake.read_records(name, schema or T.StructType([]), lake.raw_partitions(name))
        out[name] = by_field(drift_report(records, schema))
        order = F.to_json(RECORD_COLUMN) if schema is None else F.col(schema.fieldNames()[0])
        shown = records.where(F.col(CORRUPT_COLUMN).isNull()).withColumn("_order", order)
        shown = shown.select("_order", *(schema.fieldNames() if schema is not None else [RECORD_COLUMN]))
        write_json_sample(shown, f"{lake.root}/test-output/{name}", ["_order"], sample_rows, drop=["_order"])
    return out


# --- D15: the dashboard's queries ----------------------------------------------

def dashboard(lake: Lake, preview_rows: int = 100) -> dict[str, DataFrame]:
    """Every section of the dashboard page as a DataFrame (no UI):

    ``totals`` (events, videos, visitors), ``visitors_by_media``, and for the
    channel / browser / top-videos tables both the table and its chart series
    (x column plus the first numeric column); ``preview`` is the first rows of
    the fact. A table that does not exist, or lacks the chart's x column, is
    skipped, as the page does.
    """
    spark = lake.spark
    present = set(register_dashboard(lake))
    out: dict[str, DataFrame] = {}
    if "fact_visitor_engagement" in present:
        fact = spark.table("fact_visitor_engagement")
        out["totals"] = kpi.totals(fact)
        if {"media_id", "visitor_id"} <= set(fact.columns):
            out["visitors_by_media"] = kpi.distinct_visitors(
                fact, ["media_id"], out="unique_visitors", drop_null_keys=True, order="key")
        order = [c for c in ("event_key",) if c in fact.columns] or fact.columns[:1]
        out["preview"] = kpi.preview(fact, order, preview_rows)
    for table, x in (("visitors_in_each_channel", "channel"),
                     ("visitors_in_each_browser", "browser"), ("top_videos", "media_id")):
        if table in present:
            df = spark.sql(f"SELECT * FROM {table}")
            out[table] = df
            series = kpi.chart_series(df, x)
            if series is not None:
                out[f"{table}_chart"] = series
    return out
