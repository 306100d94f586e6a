"""One key holding a third of all rows, plus many NULL keys: results stay
whole and exact on every join/aggregate path."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import kpi
from tidemark.operators.dedup import latest_per_key, newest_first
from tidemark.operators.upsert import upsert
from tidemark.session import fresh_dir
from tidemark.sources.snapshots import SnapshotTable

N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    # id % 3 == 0 -> hot media 'hot'; id % 7 == 1 -> NULL media; else ~100 media
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .when(F.col("id") % 7 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("m"), (F.col("id") % 100).cast("string"))).alias("media_id"),
        (F.col("id") % 997).cast("string").alias("visitor_id"),
        F.col("id").alias("t"))


def test_distinct_visitors_hot_key_exact(spark, skewed):
    got = {r["media_id"]: r["number_of_visitors"]
           for r in kpi.distinct_visitors(skewed, ["media_id"]).collect()}
    exp = {r["media_id"]: r["n"] for r in skewed.groupBy("media_id")
           .agg(F.countDistinct("visitor_id").alias("n")).collect()}
    assert got == exp and got["hot"] == 997


def test_latest_per_key_hot_and_null_keys(spark, skewed):
    out = latest_per_key(skewed, ["media_id"], newest_first("t"))
    got = {r["media_id"]: r["t"] for r in out.collect()}
    exp = {r["media_id"]: r["m"] for r in skewed.groupBy("media_id").agg(F.max("t").alias("m")).collect()}
    assert got == exp


@pytest.mark.parametrize("bc", [True, False])
def test_upsert_with_hot_null_keys_both_strategies(spark, skewed, bc):
    target = skewed.select(F.col("media_id").alias("k"), "t")   # NULL keys and a dup-heavy key
    target = latest_per_key(target.filter(F.col("k").isNotNull()), ["k"], newest_first("t")) \
        .unionByName(target.filter(F.col("k").isNull()))
    batch = spark.createDataFrame([("hot", -1), ("new", -2), (None, -3)], "k string, t long")
    out = upsert(target, batch, ["k"], broadcast=bc)
    n_null = target.filter("k IS NULL").count()
    assert out.filter("k IS NULL").count() == n_null + 1
    assert {r["t"] for r in out.filter("k = 'hot'").collect()} == {-1}
    assert out.filter("k = 'new'").count() == 1
    assert out.count() == target.count() + 2


def test_snapshot_expire_keeps_newest(spark):
    t = SnapshotTable(spark, fresh_dir(spark, "tbl"))
    for i in range(4):
        t.write(spark.range(i + 1))
    assert t.committed() == [1, 2, 3, 4]
    assert t.expire(keep=2) == [1, 2]
    assert t.committed() == [3, 4] and t.read().count() == 4
    assert t.expire(keep=2) == []


def test_channel_kpi_sort_merge_path_with_hot_media(spark, skewed):
    """Broadcast limit forced to 1 byte: the dimension is not broadcast, the
    hot media goes through a shuffled join, and counts stay exact."""
    dim = skewed.select("media_id").distinct().filter(F.col("media_id").isNotNull()) \
        .withColumn("channel", F.when(F.col("media_id") == "hot", "YouTube").otherwise("Unknown"))
    spark.conf.set("tidemark.broadcast.maxBytes", "1")
    try:
        out = kpi.visitors_by_channel(skewed, dim)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r["channel"]: r["number_of_visitors"] for r in out.collect()}
    finally:
        spark.conf.unset("tidemark.broadcast.maxBytes")
    assert "SortMergeJoin" in plan
    exp_hot = skewed.filter("media_id = 'hot'").select("visitor_id").distinct().count()
    exp_unknown = skewed.filter("media_id <> 'hot'").select("visitor_id").distinct().count()
    exp_null = skewed.filter("media_id IS NULL").select("visitor_id").distinct().count()
    assert got == {"YouTube": exp_hot, "Unknown": exp_unknown, None: exp_null}


def test_approximate_distinct_is_opt_in_and_close(spark, skewed):
    exact = {r["media_id"]: r["number_of_visitors"]
             for r in kpi.distinct_visitors(skewed, ["media_id"]).collect()}
    approx = {r["media_id"]: r["number_of_visitors"]
              for r in kpi.distinct_visitors(skewed, ["media_id"], approx_rsd=0.02).collect()}
    assert set(exact) == set(approx)
    for k, v in exact.items():
        assert abs(approx[k] - v) <= max(2, 0.08 * v)
