"""Kept distinct counts, hot-key joins, drift reports and late records."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import joins, report, sketches
from tidemark.plans import jobs
from tidemark.session import fresh_dir
from tidemark.sources.append import AppendTable
from tidemark.sources.files import parse_records
from tidemark.sources.partitioned import PartitionedTable
from tidemark.streaming.late import keep_in_time
from tests.conftest import rows
from tests.test_jobs import _event, _land


# --- hot keys ----------------------------------------------------------------------

def _skewed(spark, n=6000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 97 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    return spark.range(n).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_is_the_plain_join(spark, how):
    fact = _skewed(spark)
    dim = spark.range(400).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"),
                                  (F.col("id") * 2).alias("v"))
    dim = dim.unionByName(spark.createDataFrame([("hot", -1), ("hot", -2), (None, -3)], "k string, v bigint"))
    got = joins.split_join(fact, dim, "k", how, parts=8)
    assert got.columns == fact.join(dim, "k", how).columns
    assert rows(got) == rows(fact.join(dim, "k", how))


def test_split_join_balances_a_hot_key(spark):
    fact = _skewed(spark, 60_000).where("k IS NOT NULL")
    dim = fact.select("k").distinct().withColumn("v", F.lit(1))
    assert list(joins.hot_keys(fact, "k", 1 / 8)) == ["hot"]
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        def sizes(df):
            return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = sizes(fact.join(dim.hint("merge"), "k"))
        split = sizes(joins.split_join(fact, dim, "k"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(plain) > 20_000                     # the hot key meets in one task
    hot = sorted(split)
    assert max(hot) <= 2 * hot[len(hot) // 2]


def test_split_join_without_a_hot_key_or_rows(spark):
    fact = spark.range(100).select("id", F.col("id").cast("string").alias("k"))
    dim = fact.select("k", F.lit(1).alias("v"))
    assert joins.split_join(fact, dim, "k", parts=4).count() == 100
    assert joins.split_join(fact.limit(0), dim, "k").count() == 0


# --- sketches and bitmaps --------------------------------------------------------------

def test_numbers_are_dense_and_stay(spark):
    first = sketches.number_new(None, spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string"), "v")
    first = spark.createDataFrame(first.collect(), first.schema)
    more = sketches.number_new(first, spark.range(50).select(F.concat(F.lit("n"), "id").alias("v")).unionByName(
        first.select("v")).repartition(5), "v")
    assert sorted(r.number for r in first.collect()) == [1, 2]
    assert sorted(r.number for r in more.collect()) == list(range(3, 53))


def test_bitmaps_count_exactly_over_increments(spark):
    visits = spark.range(3000).select((F.col("id") % 7).cast("string").alias("media_id"),
                                      (F.col("id") * 37 % 1100).cast("string").alias("visitor_id"))
    numbers, bits = None, None
    for part in (visits.where("visitor_id < '5'"), visits):
        new = sketches.number_new(numbers, part, "visitor_id")
        numbers = new if numbers is None else numbers.unionByName(new)
        bits = sketches.merge_bitmaps(bits, sketches.visitor_bitmaps(part, numbers, ["media_id"]), ["media_id"])
    assert rows(sketches.count_bitmaps(bits, ["media_id"])) == rows(
        visits.groupBy("media_id").agg(F.count_distinct("visitor_id")))
    assert sketches.count_all(bits).first()[0] == visits.select("visitor_id").distinct().count()


def test_sketches_are_near_the_exact_count(spark):
    visits = spark.range(60_000).select((F.col("id") % 3).alias("media_id"), (F.col("id") % 5).alias("day"),
                                        (F.col("id") % 20_000).alias("visitor_id"))
    daily = sketches.visitor_sketches(visits, "day", ["media_id"])
    assert daily.count() == 15
    for r in sketches.merge_sketches(daily.where("day < 4"), ["media_id"]).collect():
        exact = visits.where(f"day < 4 AND media_id = {r.media_id}").select("visitor_id").distinct().count()
        assert abs(r.unique_visitors - exact) <= 0.08 * exact


def test_kept_counts_follow_the_fact(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    def load(day, records):
        _land(lake, "events", f"d{day}", f"2024-01-0{day}", records)
        jobs.raw_to_bronze(lake, entities=[jobs.EVENTS])
        jobs.bronze_to_silver(lake)
        jobs.curate(lake)
        return jobs.keep_visitor_counts(lake)
    def counts():
        bits = lake.table("curated", "visitor_bitmaps").read()
        sketch = lake.table("curated", "visitor_sketches").read()
        return (rows(sketches.count_bitmaps(bits, ["media_id"])),
                rows(sketches.merge_sketches(sketch, ["media_id"]), "media_id", "unique_visitors"))
    assert load(1, [_event("e1", "2024-01-01T00:00:00Z"), _event("e2", "2024-01-01T00:00:00Z", v="v2")]) == 2
    assert counts() == ([("m1", 2)], [("m1", 2)])
    first = [f for f in lake.table("curated", "visitor_sketches").files() if "2024-01-01" in f]
    assert load(2, [_event("e3", "2024-01-02T00:00:00Z"), _event("e4", "2024-01-02T00:00:00Z", v="v3", m="m2")]) == 2
    assert counts() == ([("m1", 2), ("m2", 1)], [("m1", 2), ("m2", 1)])
    # dates without new events are not made again
    assert [f for f in lake.table("curated", "visitor_sketches").files() if "2024-01-01" in f] == first
    assert load(2, [_event("e3", "2024-01-02T00:00:00Z")]) == 0


def test_merged_dates_do_not_scan_the_fact(spark):
    lake = jobs.Lake(spark, fresh_dir(spark, "lake"))
    _land(lake, "events", "a", "2024-01-01", [_event("e1", "2024-01-01T00:00:00Z")])
    jobs.run_all(lake)
    jobs.keep_visitor_counts(lake)
    sketch = lake.table("curated", "visitor_sketches").read().where("event_date = '2024-01-01'")
    plan = sketches.merge_sketches(sketch, ["media_id"])._jdf.queryExecution().executedPlan().toString()
    assert "visitor_sketches" in plan and "fact_visitor_engagement" not in plan
    assert "PartitionFilters" in plan


# --- drift ------------------------------------------------------------------------------

def _report(spark, lines, schema):
    df = spark.createDataFrame([(x, "f") for x in lines], "value string, source_file string")
    records = parse_records(df, schema)
    return records, {(r["column"], r["kind"]): (r["records"], r["declared"], r["state"])
                     for r in report.drift_report(records, schema).collect()}


def test_drift_in_one_pass(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("s", T.StructType([T.StructField("x", T.LongType())])),
                           T.StructField("list", T.ArrayType(T.LongType())), T.StructField("gone", T.StringType())])
    lines = ['{"k":"a","n":1,"s":{"x":1,"y":{"z":true}},"list":[1]}', '{"k":"b","n":"7","more":null}',
             '{"k":"c","n":"x","s":{}}', '{"k":"d","list":["u"]}', "{broken", "[5]", ""]
    records, seen = _report(spark, lines, schema)
    assert seen[("k", "STRING")] == (4, "string", "as declared")
    assert seen[("n", "BIGINT")] == (1, "bigint", "as declared")
    assert seen[("n", "STRING")] == (2, "bigint", "retyped")
    assert seen[("s.x", "BIGINT")] == (1, "bigint", "as declared")
    assert seen[("s.y.z", "BOOLEAN")] == (1, None, "extra")
    assert seen[("more", "VOID")] == (1, None, "extra") and seen[("s", "OBJECT")] == (1, None, "extra")
    assert seen[("list", "ARRAY")] == (2, "array<bigint>", "retyped")
    assert seen[("gone", None)] == (0, "string", "absent")
    plan = report.drift_report(records, schema)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") <= 1 + 1          # the records once, and the declared names


def test_drift_of_nothing_and_without_a_schema(spark):
    _, seen = _report(spark, [], T.StructType([T.StructField("k", T.StringType())]))
    assert seen == {("k", None): (0, "string", "absent")}
    _, seen = _report(spark, ['{"a":{"b":1}}'], T.StructType([]))
    assert seen == {("a.b", "BIGINT"): (1, None, "extra")}


# --- late records -----------------------------------------------------------------------

def test_kept_and_late_are_all(spark):
    path, day = fresh_dir(spark, "in"), lambda n: dt.datetime(2024, 1, n)
    batches = [[("a", day(10)), ("b", day(8)), ("a", day(9)), ("n", None)],
               [("c", day(1)), ("d", day(7)), ("b", day(9)), ("e", day(20))],
               [("f", day(14)), ("g", day(16)), ("e", day(21))]]
    schema = "k string, t timestamp_ntz"
    kept = PartitionedTable(spark, fresh_dir(spark, "kept"), "d")
    late = AppendTable(spark, fresh_dir(spark, "late"))
    checkpoint = fresh_dir(spark, "ckpt")
    for at, batch in enumerate(batches):           # three runs of the stream, one file each
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{path}/f={at}")
        stream = spark.readStream.schema(schema).parquet(path).select("k", "t")
        keep_in_time(stream, "k", "t", dt.timedelta(days=5), kept, late, checkpoint)
    assert rows(kept.read(), "k", "t") == [("a", day(9)), ("b", day(8)), ("d", day(7)), ("e", day(20)),
                                           ("g", day(16))]
    got = {r.k: (r.epoch, r.watermark) for r in late.read().collect()}
    assert got == {"n": (0, None), "c": (1, day(5)), "f": (2, day(15))}
