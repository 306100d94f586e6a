"""What the layers move and store: wide rows are shuffled, kept and landed only as far as needed."""

import os
import re

import pytest

from tidemark.operators import dedup
from tidemark.operators.upsert import staged, without
from tidemark.plans import jobs
from tidemark.session import fresh_dir, work_dir
from tidemark.sources.files import read_text_records
from tests.conftest import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _staged(spark):
    return {n for n in os.listdir(work_dir(spark).removeprefix("file:")) if n.startswith("staged-")}


def test_rows_alone_with_their_key_are_not_shuffled(spark):
    some = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n"), (None, 3, "m"),
                                  ("c", None, "c")], "k string, t int, v string")
    order = dedup.newest_first("t", "v")
    found = dedup.latest_of_few(some, ["k"], order)
    assert found.columns == some.columns
    assert rows(found) == rows(dedup.latest_per_key(some, ["k"], order))
    alone = dedup.latest_of_few(some.where("v in ('y', 'z', 'c')"), ["k"], order)
    assert rows(alone, "v") == [("c",), ("y",), ("z",)] and "Exchange" not in _plan(alone)


@pytest.mark.parametrize("broadcast", [True, False])
def test_without_is_the_anti_join(spark, broadcast):
    target = spark.range(1000).selectExpr("if(id % 100 = 0, null, cast(id AS string)) AS k", "id AS v")
    gone = spark.range(0, 1000, 7).selectExpr("cast(id AS string) AS k").unionByName(
        spark.createDataFrame([(None,)], "k string"))
    left = without(target, gone, ["k"], broadcast)
    assert left.columns == target.columns
    assert rows(left) == rows(target.join(gone, "k", "left_anti").select(*target.columns))
    assert broadcast or {"Union", "SortMergeJoin", "BroadcastHashJoin"} <= set(re.findall(r"\w+", _plan(left)))


def test_staged_rows_are_read_by_column_and_go(spark):
    before = _staged(spark)
    with staged(spark.range(5).selectExpr("id", "repeat('x', 1000) AS wide")) as kept:
        assert len(_staged(spark) - before) == 1
        assert "wide" not in _plan(kept.select("id")) and kept.count() == 5
    assert _staged(spark) == before


def test_landed_json_is_compressed_and_bronze_leaves_nothing_behind(spark):
    before = _staged(spark)
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    records = spark.range(0, 1600, 1, 16).selectExpr(
        "cast(id % 1500 AS string) AS event_key", "concat('2024-01-0', id % 3 + 1, 'T00:00:00Z') AS received_at")
    assert jobs.land(lake, jobs.EVENTS, records) == 1600
    files = [f for _, _, names in os.walk(lake.raw("events")) for f in names if f.startswith("part-")]
    assert 1 <= len(files) <= 6 and all(f.endswith(".json.gz") for f in files)
    for _ in range(2):
        jobs.raw_to_bronze(lake, entities=[jobs.EVENTS])
    assert lake.table("bronze", "events").read().count() == 1500
    assert _staged(spark) == before


def test_multi_line_lines_are_shuffled_without_their_path(spark):
    path = fresh_dir(spark, "pretty")
    for page, text in (("1", '[\n{"a": 1},\n{"a": 2}\n]'), ("2", '{\n"a": 3\n}\n{"a": 4}')):
        os.makedirs(f"{path}/page={page}")
        with open(f"{path}/page={page}/f.json", "w") as f:
            f.write(text)
    found = read_text_records(spark, path, True, ("page",))
    plan = _plan(found)
    assert "hashpartitioning(_file" in plan and "hashpartitioning(source_file" not in plan
    assert [(r.page, r.value) for r in sorted(found.collect(), key=lambda r: (r.page, r.value))] == [
        ("1", '{"a": 1}'), ("1", '{"a": 2}'), ("2", '{\n"a": 3\n}'), ("2", '{"a": 4}')]
    assert all(f"page={r.page}" in r.source_file for r in found.collect())
