import json
import os

from tidemark import schemas
from tidemark.operators.flatten import flatten_media, flatten_visitors
from tidemark.sources.files import read_json
from tests.conftest import rows


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f, indent=2)   # pretty-printed, as landed by the API poller


def test_assets_missing_empty_one_many_and_collision(spark, tmp_path):
    root = str(tmp_path / "media_metadata")
    base = {"updated": "2024-01-01T00:00:00Z", "thumbnail": {"url": "u", "width": 1, "height": 1}}
    _write(f"{root}/media_id=a/x.json", {**base, "hashed_id": "a"})                    # missing
    _write(f"{root}/media_id=b/x.json", {**base, "hashed_id": "b", "assets": []})      # empty
    _write(f"{root}/media_id=c/x.json", {**base, "hashed_id": "c",
                                         "assets": [{"type": "mp4", "width": 640}]})
    _write(f"{root}/media_id=d/x.json", {**base, "hashed_id": "d", "assets": [
        {"type": "mp4", "width": 640, "height": None},
        {"type": "mp4", "width": None, "height": 640},
        {"type": "hls", "width": 1, "height": 2}]})
    raw = read_json(spark, root, schemas.MEDIA_METADATA, partition_columns=("media_id",))
    flat = flatten_media(raw)
    counts = {}
    for r in flat.collect():
        counts[r["media_id"]] = counts.get(r["media_id"], 0) + 1
    assert counts == {"a": 1, "b": 1, "c": 1, "d": 3}
    keys = sorted(r["media_asset_key"] for r in flat.filter("media_id = 'd'").collect())
    assert keys == ["d_hls_1_2", "d_mp4_640", "d_mp4_640"]
    # subfolder absent everywhere -> NULL columns, not an analysis error
    assert {r["subfolder_name"] for r in flat.collect()} == {None}


def test_numeric_looking_keys_stay_text(spark, tmp_path):
    root = str(tmp_path / "visitor_detail")
    _write(f"{root}/visitor_key=0012/v.json", {"visitor_key": "0012", "last_active_at": "t",
                                               "visitor_identity": {"name": "n"}})
    _write(f"{root}/visitor_key=7e5/v.json", {"visitor_key": "7e5", "last_active_at": "t",
                                              "user_agent_details": {"browser": "b"}})
    raw = read_json(spark, root, schemas.VISITOR_DETAIL, partition_columns=("visitor_key",))
    flat = flatten_visitors(raw)
    assert rows(flat, "visitor_key", "visitor_name", "visitor_title", "browser") == [
        ("0012", "n", None, None), ("7e5", None, None, "b")]


def test_event_array_file_becomes_rows(spark, tmp_path):
    root = str(tmp_path / "events")
    _write(f"{root}/page=1/e.json", [{"event_key": "e1", "received_at": "2024-01-01T00:00:00Z"},
                                     {"event_key": "e2", "received_at": "2024-01-02T00:00:00Z"}])
    raw = read_json(spark, root, schemas.EVENT, partition_columns=("page",))
    assert rows(raw, "event_key", "page") == [("e1", "1"), ("e2", "1")]


def test_corrupt_record_is_kept_for_quarantine(spark, tmp_path):
    p = tmp_path / "bad"
    p.mkdir()
    (p / "x.json").write_text('{"event_key": "ok"}\n{not json\n')
    raw = read_json(spark, str(p), schemas.EVENT, multi_line=False, keep_corrupt=True)
    got = rows(raw, "event_key", "_corrupt_record")
    assert got == [("ok", None), (None, "{not json")]
