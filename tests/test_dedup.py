from pyspark.sql import functions as F

from tidemark.functions import parse_iso
from tidemark.operators.dedup import distinct_on, latest_per_key, newest_first, oldest_first
from tests.conftest import rows


def test_latest_per_key_edges(spark):
    df = spark.createDataFrame([
        ("a", "2024-01-01T00:00:00Z", "f1"),
        ("a", "2024-01-02T00:00:00Z", "f1"),       # newest
        ("b", None, "f1"),                         # only row, NULL time: kept
        ("c", "2024-01-01T00:00:00Z", "f1"),
        ("c", "2024-01-01T00:00:00Z", "f2"),       # tie: newest file wins
        ("d", "2024-01-01T00:00:00Z", "f1"),
        ("d", "2024-01-01T00:00:00.5Z", "f1"),     # instants, not text order
        ("d", "2024-01-01T02:00:00+05:00", "f1"),
        ("e", None, "f1"),
        ("e", "2020-01-01T00:00:00Z", "f1"),       # any time beats NULL
    ], "k string, t string, f string")
    out = latest_per_key(df.withColumn("ts", parse_iso("t")), ["k"], newest_first("ts", "f"))
    assert rows(out, "k", "t", "f") == [
        ("a", "2024-01-02T00:00:00Z", "f1"), ("b", None, "f1"),
        ("c", "2024-01-01T00:00:00Z", "f2"), ("d", "2024-01-01T00:00:00.5Z", "f1"),
        ("e", "2020-01-01T00:00:00Z", "f1")]


def test_distinct_on_is_deterministic(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, "x", 3), (2, "y", 9)], "k int, v string, o int")
    out = distinct_on(df, ["k"], oldest_first("o"))
    assert rows(out) == [(1, "x", 3), (2, "y", 9)]


def test_hot_key_plans_partial_group_limit(spark):
    """A key holding most rows: the rank-1 window is limited per map task
    before the shuffle."""
    df = spark.range(0, 50000).select((F.when(F.col("id") % 3 == 0, F.lit(0))
                                       .otherwise(F.col("id"))).alias("k"),
                                      F.col("id").alias("t"))
    out = latest_per_key(df, ["k"], newest_first("t"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    got = {r["k"]: r["t"] for r in out.filter("k = 0").collect()}
    assert got == {0: 49998}
    assert out.count() == 33334
