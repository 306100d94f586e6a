"""Layer jobs end to end on small JSON fixtures, over several runs."""

import datetime as dt
import json
import os

from tidemark.plans import jobs
from tidemark.session import fresh_dir
from tests.conftest import rows


def _event(k, t, v="v1", m="m1", browser="Chrome"):
    return {"event_key": k, "received_at": t, "visitor_key": v, "media_id": m,
            "percent_viewed": 0.5, "user_agent_details": {"browser": browser}}


def _land(lake, entity, name, day, records):
    d = f"{lake.raw(entity)}/landed_date={day}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}.json", "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def test_incremental_runs_are_idempotent_and_marks_advance(spark):
    root = fresh_dir(spark, "lake")
    lake = jobs.Lake(spark, root)
    _land(lake, "events", "run1", "2024-01-01", [
        _event("e1", "2024-01-01T00:00:00Z"), _event("e2", "2024-01-01T01:00:00Z", v="v2"),
        _event("e1", "2023-12-31T00:00:00Z", browser="Old")])   # older duplicate
    jobs.raw_to_bronze(lake, now="2024-01-02T00:00:00Z", entities=[jobs.EVENTS])
    assert jobs.bronze_to_silver(lake)["events"] == 2
    silver = lake.table("silver", "events")
    assert rows(silver.read(), "event_key", "browser") == [("e1", "Chrome"), ("e2", "Chrome")]
    m1 = lake.marks.get("silver_events", "1900-01-01")
    assert m1 == dt.datetime(2024, 1, 2)

    # Same raw again: bronze keeps its rows (nothing strictly newer), silver sees nothing new.
    jobs.raw_to_bronze(lake, now="2024-01-03T00:00:00Z", entities=[jobs.EVENTS])
    assert jobs.bronze_to_silver(lake)["events"] == 0
    assert lake.marks.get("silver_events", "1900-01-01") == m1

    # A newer version of e2 and a new key arrive.
    _land(lake, "events", "run2", "2024-01-04", [
        _event("e2", "2024-01-04T00:00:00Z", v="v2", browser="Firefox"),
        _event("e3", "2024-01-04T00:00:00Z", v="v3")])
    jobs.raw_to_bronze(lake, now="2024-01-05T00:00:00Z", entities=[jobs.EVENTS])
    assert jobs.bronze_to_silver(lake)["events"] == 2
    assert rows(silver.read(), "event_key", "browser") == [
        ("e1", "Chrome"), ("e2", "Firefox"), ("e3", "Chrome")]
    assert lake.marks.get("silver_events", "1900-01-01") == dt.datetime(2024, 1, 5)


def test_stream_equals_batch(spark):
    recs = [_event("e1", "2024-01-01T00:00:00Z"), _event("e2", "2024-01-02T00:00:00Z"),
            _event("e1", "2024-01-03T00:00:00Z", browser="New")]
    batch_lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    stream_lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    for lk in (batch_lake, stream_lake):
        _land(lk, "events", "a", "2024-01-01", recs[:2])
    jobs.raw_to_bronze(batch_lake, entities=[jobs.EVENTS])
    jobs.raw_to_bronze_stream(stream_lake, jobs.EVENTS)
    # late file with an older version of e1 plus a newer one, second stream run
    for lk in (batch_lake, stream_lake):
        _land(lk, "events", "b", "2024-01-03", recs[2:] + [
            _event("e2", "2023-01-01T00:00:00Z", browser="Stale")])
    jobs.raw_to_bronze(batch_lake, entities=[jobs.EVENTS])
    jobs.raw_to_bronze_stream(stream_lake, jobs.EVENTS)
    cols = ("event_key", "received_at")
    b = rows(batch_lake.table("bronze", "events").read(), *cols)
    s = rows(stream_lake.table("bronze", "events").read(), *cols)
    assert b == s == [("e1", "2024-01-03T00:00:00Z"), ("e2", "2024-01-02T00:00:00Z")]
    # a third stream run with no new files changes nothing
    before = stream_lake.table("bronze", "events").files()
    jobs.raw_to_bronze_stream(stream_lake, jobs.EVENTS)
    assert stream_lake.table("bronze", "events").files() == before


def test_full_lake_to_kpis(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    _land(lake, "events", "a", "2024-01-01", [
        _event("e1", "2024-01-01T00:00:00Z", v="v1", m="m1"),
        _event("e2", "2024-01-01T00:00:00Z", v="v2", m="m1", browser="Safari"),
        _event("e3", "2024-01-01T00:00:00Z", v="v1", m="m2")])
    _land(lake, "media_metadata", "a", "2024-01-01", [
        {"hashed_id": "m1", "name": "FB promo", "updated": "2024-01-01T00:00:00Z",
         "assets": [{"type": "mp4", "width": 1, "height": 1}]},
        {"hashed_id": "m2", "name": "cut", "updated": "2024-01-01T00:00:00Z"},
        {"hashed_id": "m2", "name": "YouTube cut", "updated": "2024-02-01T00:00:00Z"}])
    _land(lake, "visitor_detail", "a", "2024-01-01", [
        {"visitor_key": "v1", "last_active_at": "2024-01-01T00:00:00Z",
         "visitor_identity": {"name": "A", "org": {"name": "O", "title": "T"}}}])
    os.makedirs(lake.raw("media_summary"), exist_ok=True)
    with open(f"{lake.raw('media_summary')}/s.json", "w") as f:
        f.write(json.dumps({"media_id": "m1", "play_count": 5, "hours_watched": 1.0}) + "\n")
        f.write(json.dumps({"media_id": "m2", "play_count": 7, "hours_watched": 2.0}) + "\n")
    jobs.run_all(lake, now="2024-03-01T00:00:00Z")
    ch = lake.table("curated", "visitors_in_each_channel").read()
    assert rows(ch) == [("Facebook", 2), ("YouTube", 1)]
    top = lake.table("curated", "top_videos").read()
    assert rows(top, "media_id", "channel", "play_count") == [("m1", "Facebook", 5),
                                                              ("m2", "YouTube", 7)]
    gold = lake.table("gold", "dim_media").read()
    assert rows(gold, "media_id", "title", "channel") == [("m1", "FB promo", "Facebook"),
                                                          ("m2", "YouTube cut", "YouTube")]
    dv = lake.table("gold", "dim_visitor").read()
    assert rows(dv, "visitor_key", "visitor_title", "organization_name") == [("v1", "T", "O")]
    assert sorted(jobs.register_dashboard(lake)) == sorted(jobs.DASHBOARD_TABLES)
    assert spark.sql("SELECT count(*) FROM fact_visitor_engagement").first()[0] == 3
    page = jobs.dashboard(lake)
    assert tuple(page["totals"].first()) == (3, 2, 2)
    assert [tuple(r) for r in page["visitors_by_media"].collect()] == [("m1", 2), ("m2", 1)]
    assert page["top_videos_chart"].columns == ["media_id", "total_hours_watched"]
    assert page["visitors_in_each_browser_chart"].columns == ["browser", "number_of_visitors"]
    assert page["preview"].count() == 3


def test_schema_test_reports_and_samples(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    _land(lake, "events", "a", "2024-01-01", [_event(f"e{i}", "2024-01-01T00:00:00Z")
                                             for i in range(8)])
    reports = jobs.schema_test(lake)
    assert list(reports) == ["events"]
    rep = {r["column"]: r["non_null"] for r in reports["events"].collect()}
    assert rep["event_key"] == 8 and rep["ip"] == 0 and rep["user_agent_details.browser"] == 8
    sample = spark.read.json(f"{lake.root}/test-output/events")
    assert sample.count() == 5


def _pretty(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f, indent=2)


def test_poller_layout_multiline_by_key(spark):
    """Raw folders as the API poller writes them: one pretty-printed object
    per media / visitor, a JSON array per events page; keys like 0012 stay text."""
    from tidemark.plans import cli
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"), raw_multi_line=True, raw_layout="by_key")
    _pretty(f"{lake.raw('visitor_detail')}/visitor_key=0012/a.json",
            {"visitor_key": "0012", "last_active_at": "2024-01-01T00:00:00Z",
             "user_agent_details": {"browser": "Chrome"}})
    _pretty(f"{lake.raw('visitor_detail')}/visitor_key=0012/b.json",
            {"visitor_key": "0012", "last_active_at": "2024-01-02T00:00:00Z",
             "user_agent_details": {"browser": "Firefox"}})
    _pretty(f"{lake.raw('media_metadata')}/media_id=v1/a.json",
            {"hashed_id": "v1", "name": "yt clip", "updated": "2024-01-01T00:00:00Z",
             "assets": [{"type": "mp4", "width": 1, "height": 2}, {"type": "hls"}]})
    _pretty(f"{lake.raw('events')}/page=1/a.json",
            [_event("e1", "2024-01-01T00:00:00Z", v="0012", m="v1"),
             _event("e2", "2024-01-01T00:00:00Z", v="0013", m="v1")])
    out = cli.run(spark, lake, ["bronze", "silver", "gold"])
    assert out["silver"] == {"media_metadata_flattened": 1, "visitor_list": 1, "events": 2}
    v = lake.table("gold", "dim_visitor").read()
    assert rows(v, "visitor_key", "browser") == [("0012", "Firefox")]
    m = lake.table("silver", "media_metadata_flattened").read()
    assert rows(m, "media_asset_key") == [("v1_hls",), ("v1_mp4_1_2",)]
    assert rows(lake.table("gold", "dim_media").read(), "media_id", "channel") == [("v1", "YouTube")]


def test_cli_stream_then_expire(spark):
    from tidemark.plans import cli
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    _land(lake, "events", "a", "2024-01-01", [_event("e1", "2024-01-01T00:00:00Z")])
    cli.run(spark, lake, ["bronze-stream", "silver"])
    _land(lake, "events", "b", "2024-01-02", [_event("e1", "2024-01-02T00:00:00Z", browser="New")])
    out = cli.run(spark, lake, ["bronze-stream", "silver", "expire"], keep=1)
    assert rows(lake.table("silver", "events").read(), "event_key", "browser") == [("e1", "New")]
    assert out["expire"]["silver/events"] == []      # partitions are replaced, no version stays
    assert lake.table("bronze", "events").partitions() == ["2024-01-02"]


def test_corrupt_raw_lines_are_quarantined(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    d = f"{lake.raw('events')}/landed_date=2024-01-01"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/x.json", "w") as f:
        f.write(json.dumps(_event("e1", "2024-01-01T00:00:00Z")) + "\n")
        f.write('{"event_key": "e2", "received_at": \n')          # truncated record
    jobs.raw_to_bronze(lake, now="2024-01-02T00:00:00Z", entities=[jobs.EVENTS])
    assert rows(lake.table("bronze", "events").read(), "event_key") == [("e1",)]
    q = lake.table("quarantine", "events").read()
    assert q.count() == 1 and "e2" in q.first()["_corrupt_record"]


def test_loads_with_equal_earlier_and_concurrent_times_all_reach_silver(spark):
    """What decides is the load, not its time: none is lost, none is consumed twice."""
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    times = ["2024-01-05T00:00:00Z", "2024-01-05T00:00:00Z", "2024-01-04T00:00:00Z"]
    for i, now in enumerate(times):
        _land(lake, "events", f"f{i}", "2024-01-01", [_event(f"e{i}", "2024-01-01T00:00:00Z")])
        jobs.raw_to_bronze(lake, now=now, entities=[jobs.EVENTS])
        assert jobs.bronze_to_silver(lake)["events"] == 1
    assert lake.marks.get("silver_events", "1900-01-01") == dt.datetime(2024, 1, 5)    # never back
    # a batch load and a stream that both commit before silver runs
    _land(lake, "events", "f3", "2024-01-02", [_event("e3", "2024-01-02T00:00:00Z")])
    jobs.raw_to_bronze(lake, now="2024-01-03T00:00:00Z", entities=[jobs.EVENTS])
    _land(lake, "events", "f4", "2024-01-01", [_event("e4", "2024-01-01T00:00:00Z")])
    jobs.raw_to_bronze_stream(lake, jobs.EVENTS)
    assert jobs.bronze_to_silver(lake)["events"] == 2
    assert jobs.bronze_to_silver(lake)["events"] == 0
    keys = [(f"e{i}",) for i in range(5)]
    assert rows(lake.table("bronze", "events").read(), "event_key") == keys
    assert rows(lake.table("silver", "events").read(), "event_key") == keys


def test_bronze_reads_only_files_it_has_not_read(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    _land(lake, "events", "a", "2024-01-01", [_event("e1", "2024-01-01T00:00:00Z")])
    assert jobs.raw_to_bronze(lake, entities=[jobs.EVENTS]) == {"events": 1}
    before = lake.table("bronze", "events").files()
    assert jobs.raw_to_bronze(lake, entities=[jobs.EVENTS]) == {"events": 0}
    assert lake.table("bronze", "events").files() == before
    # a file that changed in place is read again, and a late one in an old folder too
    _land(lake, "events", "a", "2024-01-01", [_event("e1", "2024-01-02T00:00:00Z", browser="New"),
                                             _event("e2", "2024-01-01T00:00:00Z")])
    _land(lake, "events", "z", "2023-12-01", [_event("e3", "2023-12-01T00:00:00Z")])
    assert jobs.raw_to_bronze(lake, entities=[jobs.EVENTS]) == {"events": 2}
    assert rows(lake.table("bronze", "events").read(), "event_key", "received_at") == [
        ("e1", "2024-01-02T00:00:00Z"), ("e2", "2024-01-01T00:00:00Z"), ("e3", "2023-12-01T00:00:00Z")]


def test_stream_quarantines_corrupt_lines(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    d = f"{lake.raw('events')}/landed_date=2024-01-01"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/x.json", "w") as f:
        f.write(json.dumps(_event("e1", "2024-01-01T00:00:00Z")) + "\n{broken\n")
    jobs.raw_to_bronze_stream(lake, jobs.EVENTS)
    assert rows(lake.table("bronze", "events").read(), "event_key") == [("e1",)]
    assert rows(lake.table("quarantine", "events").read(), "_corrupt_record") == [("{broken",)]


def test_land_allow_list_and_marks(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    media = spark.createDataFrame(
        [("v1", "2024-01-01T00:00:00Z"), ("v2", "2024-01-02T00:00:00Z"),
         ("v3", "2024-01-03T00:00:00Z")], "hashed_id string, updated string")
    assert jobs.land(lake, jobs.MEDIA_METADATA, media, allowed=["v1", "v3"]) == 2
    assert lake.marks.get("landing_media_metadata", "2000-01-01") == dt.datetime(2024, 1, 3)
    # same records again: nothing newer than the mark, nothing landed, mark kept
    assert jobs.land(lake, jobs.MEDIA_METADATA, media, allowed=["v1", "v3"]) == 0
    landed = lake.read_raw(jobs.MEDIA_METADATA)
    assert rows(landed, "hashed_id") == [("v1",), ("v3",)]


def test_land_visitors_list_to_detail(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    vlist = spark.createDataFrame([("a", "2024-01-01T00:00:00Z"), ("b", None),
                                   (None, "2024-01-05T00:00:00Z")],
                                  "visitor_key string, last_active_at string")
    detail = spark.createDataFrame([("a", "2024-01-01T00:00:00Z"), ("b", "2024-01-02T00:00:00Z"),
                                    ("c", "2024-01-03T00:00:00Z")],
                                   "visitor_key string, last_active_at string")
    assert jobs.land_visitors(lake, vlist, detail) == 1       # only 'a': b has no time, key-less row skipped
    # the key-less record never moved the mark
    assert lake.marks.get("landing_visitor_detail", "2000-01-01") == dt.datetime(2024, 1, 1)


def test_cli_main_all_steps(spark, capsys):
    from tidemark.plans import cli
    root = fresh_dir(spark, "lake")
    lake = jobs.Lake(spark, root)
    _land(lake, "events", "a", "2024-01-01", [_event("e1", "2024-01-01T00:00:00Z"),
                                             _event("e2", "2024-01-01T00:00:00Z", v="v2")])
    cli.main(["--root", root, "--lateness-hours", "1", "all", "schema-test"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["silver"]["events"] == 2 and out["schema-test"] == ["events"]
    fact = lake.table("curated", "fact_visitor_engagement").read()
    assert rows(fact, "event_key") == [("e1",), ("e2",)]


def test_damaged_records_of_every_entity_are_counted(spark):
    """Broken lines, badly typed fields and missing keys, batch and stream, two runs."""
    for stream in (False, True):
        lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
        bad = {"media_metadata": ({"hashed_id": "m1"}, {"hashed_id": "m2", "duration": "abc"}, {"name": "x"}),
               "events": (_event("e1", None), _event("e2", "2024-01-01T00:00:00Z") | {"percent_viewed": "n/a"},
                          {"media_id": "m"}),
               "visitor_detail": ({"visitor_key": "v1"}, {"visitor_key": "v2", "load_count": {}}, {"created_at": "t"})}
        for run in (1, 2):
            for entity, (good, typed, nokey) in bad.items():
                _land(lake, entity, f"run{run}", f"2024-01-0{run}", [good, typed, nokey])
                with open(f"{lake.raw(entity)}/landed_date=2024-01-0{run}/run{run}.json", "a") as f:
                    f.write("{broken\n\n{broken\n[1]\n")
            for e in jobs.ENTITIES:
                if stream:
                    jobs.raw_to_bronze_stream(lake, e)
                else:
                    jobs.raw_to_bronze(lake, entities=[e])
            for e in jobs.ENTITIES:
                assert lake.table("bronze", e.name).read().count() == 1
                q = lake.table("quarantine", e.name).read()
                n = {r["reason"]: r["n"] for r in q.groupBy("reason").sum("n_records")
                     .withColumnRenamed("sum(n_records)", "n").collect()}
                assert n == {"malformed": 4 * run, "missing_key": run}


def test_bronze_keeps_undeclared_fields_and_reruns_commit_nothing(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    _land(lake, "events", "a", "2024-01-01", [
        _event("e1", None) | {"session_note": "kept"}, _event("e2", "12024-01-01T00:00:00Z"),
        _event("e3", "2024-01-01T00:00:00Z")])
    for day in (2, 3):
        jobs.raw_to_bronze(lake, now=f"2024-01-0{day}T00:00:00Z", entities=[jobs.EVENTS])
    bronze = lake.table("bronze", "events")
    assert len({r["load_id"] for r in bronze.read().collect()}) == 1
    assert rows(bronze.read(), "event_key", jobs.EVENT_DATE) == [
        ("e1", "unknown"), ("e2", "unknown"), ("e3", "2024-01-01")]
    kept = bronze.read().where("event_key = 'e1'").selectExpr(
        "variant_get(record, '$.session_note', 'string') AS note")
    assert kept.first()["note"] == "kept"


def test_listed_visitors_wait_for_their_detail(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    listed = spark.createDataFrame([("a", "2024-01-01T00:00:00Z"), ("b", "2024-01-02T00:00:00Z")],
                                   "visitor_key string, last_active_at string")
    details = spark.createDataFrame([("a", None), ("b", "2024-01-02T00:00:00Z")],
                                    "visitor_key string, last_active_at string")
    assert jobs.land_visitors(lake, listed, details.where("visitor_key = 'a'")) == 1
    assert lake.marks.get("landing_visitor_detail", "2000-01-01") == dt.datetime(2024, 1, 2)
    assert jobs.land_visitors(lake, listed, details) == 1
    assert jobs.land_visitors(lake, listed, details) == 0
    assert rows(lake.read_raw(jobs.VISITOR_DETAIL), "visitor_key") == [("a",), ("b",)]


def test_late_records_land_within_the_window(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"), lateness=dt.timedelta(days=2))
    frame = lambda *r: spark.createDataFrame(list(r), "event_key string, received_at string")
    assert jobs.land(lake, jobs.EVENTS, frame(("e1", "2024-01-10T00:00:00Z"))) == 1
    assert jobs.land(lake, jobs.EVENTS, frame(("late", "2024-01-09T00:00:00Z"), ("old", "2024-01-01T00:00:00Z"))) == 1
    assert rows(lake.read_raw(jobs.EVENTS), "event_key") == [("e1",), ("late",)]


def test_schema_test_shows_drift_and_undeclared_folders(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    _land(lake, "events", "a", "2024-01-01", [_event("e1", "2024-01-01T00:00:00Z") | {"extra": 5}])
    _land(lake, "media_engagement", "a", "2024-01-01", [{"media": "m", "engagement": {"rate": 0.5}}])
    reports = jobs.schema_test(lake)
    seen = {r["column"]: (r["declared"], r["inferred_type"], r["non_null"]) for r in reports["events"].collect()}
    assert seen["extra"] == (False, "bigint", 1) and seen["ip"] == (True, None, 0)
    assert seen["event_key"] == (True, "string", 1) and "landed_date" not in seen
    assert {r["column"] for r in reports["media_engagement"].collect()} >= {"media", "engagement.rate"}


def test_landing_files_follow_the_data_not_the_tasks(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    records = spark.range(0, 1600, 1, 16).selectExpr(
        "cast(id AS string) AS event_key", "concat('2024-01-0', id % 3 + 1, 'T00:00:00Z') AS received_at")
    jobs.land(lake, jobs.EVENTS, records)
    files = [f for _, _, names in os.walk(lake.raw("events")) for f in names if f.endswith(".json")]
    assert len(files) <= 6


def test_expire_covers_every_table_and_mark(spark):
    from tidemark.plans import cli
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    _land(lake, "events", "a", "2024-01-01", [_event("e1", "2024-01-01T00:00:00Z")])
    for day in (2, 3, 4):
        _land(lake, "events", f"n{day}", f"2024-01-0{day}", [_event(f"e{day}", f"2024-01-0{day}T00:00:00Z")])
        cli.run(spark, lake, ["all", "expire"], keep=1)
    assert len(lake.table("curated", "dim_visitor").committed()) == 1
    assert lake.table("curated", "fact_visitor_engagement").read().count() == 4
    assert len(lake.marks._table("silver_events").committed()) == 1
