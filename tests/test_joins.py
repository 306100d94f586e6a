from tidemark.operators import kpi, report
from tidemark.operators.joins import fits_in_broadcast, sized_broadcast


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_side_is_broadcast_large_side_is_pinned_to_sort_merge(spark):
    big = spark.range(0, 20000).selectExpr("id AS k", "id * 2 AS v")
    small = spark.range(0, 10).selectExpr("id AS k", "'x' AS tag")
    assert fits_in_broadcast(small)
    assert "BroadcastHashJoin" in _plan(big.join(sized_broadcast(small), "k"))
    # the same small side measured against a 1-byte limit: never broadcast
    assert not fits_in_broadcast(small, limit_bytes=1)
    plan = _plan(big.join(sized_broadcast(small, limit_bytes=1), "k"))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_size_estimate_counts_string_bytes(spark):
    wide = spark.range(0, 100).selectExpr("repeat('a', 1000) AS s")
    assert fits_in_broadcast(wide, limit_bytes=200_000)
    assert not fits_in_broadcast(wide, limit_bytes=50_000)     # ~100 kB of text


def test_preview_and_sample_are_ordered_top_k(spark):
    df = spark.range(0, 1000).selectExpr("cast(999 - id AS string) AS event_key", "id")
    assert [r["event_key"] for r in kpi.preview(df, ["event_key"], 3).collect()] == \
        ["0", "1", "10"]                                        # text order, as SQL sorts
    assert "TakeOrderedAndProject" in _plan(report.sample(df, ["id"], 5))
    assert [r["id"] for r in report.sample(df, ["id"], 5).collect()] == [0, 1, 2, 3, 4]
