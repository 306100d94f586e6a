import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.keyfilter import key_filter, might_hold
from tidemark.operators.upsert import upsert
from tidemark.session import fresh_dir
from tidemark.sources.partitioned import PartitionedTable
from tests.conftest import rows

SCHEMA = "k string, d string, v int"


def files_of(t, value):
    return [f for f in t.files() if f"/d={value}/" in f]


def test_only_touched_partitions_are_rewritten(spark):
    t = PartitionedTable(spark, fresh_dir(spark, "pt"), "d")
    t.write(spark.createDataFrame([("a", "2024-01-01", 1), ("b", "2024-01-02", 2),
                                   ("c", "2024-01-03", 3)], SCHEMA))
    before = {d: files_of(t, d) for d in t.partitions()}
    # update a (moves from 01-01 to 01-04), insert e on 01-02
    t.upsert(spark.createDataFrame([("a", "2024-01-04", 10), ("e", "2024-01-02", 5)], SCHEMA),
             ["k"])
    assert files_of(t, "2024-01-03") == before["2024-01-03"]          # untouched: same files
    assert files_of(t, "2024-01-02") != before["2024-01-02"]
    assert t.partitions() == ["2024-01-02", "2024-01-03", "2024-01-04"]     # 01-01 emptied by the move
    assert rows(t.read(), "k", "d", "v") == [("a", "2024-01-04", 10), ("b", "2024-01-02", 2),
                                              ("c", "2024-01-03", 3), ("e", "2024-01-02", 5)]


def test_newer_than_rewrites_nothing_without_a_winner(spark):
    t = PartitionedTable(spark, fresh_dir(spark, "pt"), "d")
    t.write(spark.createDataFrame([("a", "x", 5)], SCHEMA))
    before = t.files()
    t.upsert(spark.createDataFrame([("a", "x", 3)], SCHEMA), ["k"], newer_than="v")
    assert rows(t.read(), "k", "v") == [("a", 5)] and t.files() == before
    t.upsert(spark.createDataFrame([("a", "x", 7)], SCHEMA), ["k"], newer_than="v")
    assert rows(t.read(), "k", "v") == [("a", 7)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_versions_far_apart_leave_one_row(spark, broadcast):
    t = PartitionedTable(spark, fresh_dir(spark, "pt"), "d")
    t.write(spark.createDataFrame([("1", "2024-01-01", 1), ("2", "2024-01-01", 1)], SCHEMA))
    t.upsert(spark.createDataFrame([("1", "2024-02-10", 2)], SCHEMA), ["k"], newer_than="v",
             broadcast=broadcast)
    assert rows(t.read(), "k", "d", "v") == [("1", "2024-02-10", 2), ("2", "2024-01-01", 1)]


@pytest.mark.parametrize("newer", [None, "v"])
def test_upsert_completes_one_that_broke_off(spark, newer):
    """The driver died when the new partition was in place and the old one not yet replaced."""
    t = PartitionedTable(spark, fresh_dir(spark, "pt"), "d")
    t.write(spark.createDataFrame([("a", "2024-01-01", 1), ("b", "2024-01-01", 1),
                                   ("a", "2024-01-04", 2)], SCHEMA))
    t.upsert(spark.createDataFrame([("a", "2024-01-04", 2)], SCHEMA), ["k"], newer_than=newer)
    assert rows(t.read(), "k", "d", "v") == [("a", "2024-01-04", 2), ("b", "2024-01-01", 1)]


def test_large_batches_filter_the_scan_by_key_bits(spark):
    keys = spark.range(0, 2000, 40).selectExpr("cast(id AS string) AS k", "id % 7 AS g")
    target = spark.range(2000).selectExpr("cast(id AS string) AS k", "id % 7 AS g", "id AS v")
    found = might_hold(target, key_filter(keys, ["k", "g"]), ["k", "g"])
    assert found.columns == target.columns
    held = {r["k"] for r in found.collect()}
    assert held >= {r["k"] for r in keys.collect()} and len(held) < 60
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_bad_partition_value_refused(spark):
    t = PartitionedTable(spark, fresh_dir(spark, "pt"), "d")
    for bad in ("x/y", None):
        with pytest.raises(Exception, match="must match"):
            t.write(spark.createDataFrame([("a", bad, 1)], SCHEMA))


ops = st.lists(st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from(["p1", "p2", "p3"]),
                                  st.integers(0, 9)),
                        min_size=1, max_size=5, unique_by=lambda x: x[0]),
               min_size=1, max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=ops)
def test_same_result_as_whole_table_upsert(spark, batches):
    t = PartitionedTable(spark, fresh_dir(spark, "pt"), "d")
    expected = None
    for b in batches:
        df = spark.createDataFrame(b, SCHEMA)
        t.upsert(df, ["k"])
        expected = df if expected is None else upsert(expected, df, ["k"], checkpoint=False)
    assert rows(t.read(), "k", "d", "v") == rows(expected, "k", "d", "v")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=ops)
def test_newer_than_same_result_as_whole_table_upsert(spark, batches):
    t = PartitionedTable(spark, fresh_dir(spark, "pt"), "d")
    expected = None
    for b in batches:
        df = spark.createDataFrame(b, SCHEMA)
        t.upsert(df, ["k"], newer_than="v")
        expected = df if expected is None else upsert(expected, df, ["k"], newer_than="v",
                                                      checkpoint=False)
    assert rows(t.read(), "k", "d", "v") == rows(expected, "k", "d", "v")
