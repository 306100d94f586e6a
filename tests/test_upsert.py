from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.upsert import upsert
from tests.conftest import rows

SCHEMA = "k string, v int, t int"


def test_update_insert_untouched_and_null_keys(spark):
    target = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), (None, 9, 1)], SCHEMA)
    batch = spark.createDataFrame([("a", 10, 2), ("c", 3, 1), (None, 8, 1)], SCHEMA)
    for bc in (True, False, None):
        out = upsert(target, batch, ["k"], broadcast=bc)
        assert rows(out) == [("a", 10, 2), ("b", 2, 1), ("c", 3, 1), (None, 8, 1), (None, 9, 1)]


def test_newer_than_keeps_newer_target_rows(spark):
    target = spark.createDataFrame([("a", 1, 5), ("b", 2, 5), ("c", 3, None), ("d", 4, 5)], SCHEMA)
    batch = spark.createDataFrame([("a", 10, 6),      # newer: replaces
                                   ("b", 20, 4),      # older: ignored
                                   ("c", 30, 1),      # target time NULL: replaces
                                   ("d", 40, 5),      # equal: ignored
                                   ("e", 50, None)],  # new key: inserted
                                  SCHEMA)
    for bc in (True, False):
        out = upsert(target, batch, ["k"], newer_than="t", broadcast=bc)
        assert rows(out) == [("a", 10, 6), ("b", 2, 5), ("c", 30, 1), ("d", 4, 5), ("e", 50, None)]


def test_batch_columns_align_by_name(spark):
    target = spark.createDataFrame([("a", 1, 1)], SCHEMA)
    batch = spark.createDataFrame([(7, "a", 2)], "t int, k string, v int")
    assert rows(upsert(target, batch, ["k"])) == [("a", 2, 7)]


def test_broadcast_upsert_does_not_shuffle_target(spark):
    target = spark.range(0, 100000).selectExpr("cast(id as string) as k", "1 as v", "1 as t")
    batch = spark.createDataFrame([("5", 2, 2)], SCHEMA)
    plan = upsert(target, batch, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortMergeJoin" not in plan


keys = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", "e"]), st.integers(0, 9)),
                max_size=6, unique_by=lambda x: x[0])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(t=keys, b=keys)
def test_upsert_idempotent(spark, t, b):
    target = spark.createDataFrame([(k, v, 0) for k, v in t], SCHEMA)
    batch = spark.createDataFrame([(k, v, 1) for k, v in b], SCHEMA)
    once = upsert(target, batch, ["k"], broadcast=True)
    twice = upsert(once, batch, ["k"], broadcast=True)
    assert rows(once) == rows(twice)
    assert len({r[0] for r in rows(once)}) == len(rows(once))
    assert {r[0] for r in rows(once)} == {k for k, _ in t} | {k for k, _ in b}
