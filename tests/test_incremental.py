import datetime as dt

from tidemark.operators import incremental
from tidemark.session import fresh_dir
from tidemark.sources.state import WatermarkStore
from tests.conftest import rows

MARK = "2024-01-01T00:00:00Z"


def test_accept_since_rejects_equal_null_junk_and_keyless(spark):
    df = spark.createDataFrame([
        ("v1", "2024-01-01T00:00:00Z"),        # equal to mark: rejected
        ("v2", "2024-01-01T00:00:00.001Z"),    # newer: accepted
        ("v3", None),                          # no time: rejected
        ("v4", "yesterday"),                   # junk: rejected
        (None, "2024-02-01T00:00:00Z"),        # no key: rejected
        ("", "2024-02-01T00:00:00Z"),          # empty key: rejected
        ("v7", "2024-01-01T04:00:00+05:00"),   # 23:00 the day before: rejected
    ], "k string, t string")
    out = incremental.accept_since(df, "t", MARK, key_col="k")
    assert [r[0] for r in rows(out, "k")] == ["v2"]


def test_newer_than_mark_pushes_filter_to_scan(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 2))], "id int, ts timestamp_ntz") \
        .write.parquet(p)
    df = incremental.newer_than_mark(spark.read.parquet(p), "ts", MARK)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    assert df.count() == 1


def test_advance_floors_at_previous_mark_and_empty_keeps_it(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 5)), ("a", dt.datetime(2023, 1, 1)),
                                ("b", dt.datetime(2023, 6, 1))], "g string, ts timestamp_ntz")
    out = {r["g"]: r for r in incremental.advance(df, "ts", MARK, ["g"]).collect()}
    assert out["a"]["new_mark"] == dt.datetime(2024, 1, 5) and out["a"]["accepted"] == 1
    assert out["b"]["new_mark"] == dt.datetime(2024, 1, 1) and not out["b"]["has_new"]
    total = incremental.advance(df.filter("ts > '2100-01-01'"), "ts", MARK).first()
    assert total["new_mark"] == dt.datetime(2024, 1, 1) and total["accepted"] == 0


def test_watermark_store_roundtrip_and_refuses_null(spark):
    store = WatermarkStore(spark, fresh_dir(spark, "marks"))
    assert store.get("x", "1900-01-01T00:00:00") == dt.datetime(1900, 1, 1)
    assert store.save("x", dt.datetime(2024, 1, 1, 12))
    assert store.save("y", "2024-03-01T00:00:00+01:00")
    assert not store.save("x", None)
    assert store.get("x", "1900-01-01") == dt.datetime(2024, 1, 1, 12)
    assert store.get("y", "1900-01-01") == dt.datetime(2024, 2, 29, 23)
    assert store.save("x", dt.datetime(2024, 1, 2))
    assert store.get("x", "1900-01-01") == dt.datetime(2024, 1, 2)
    assert store.all().count() == 2


def test_lateness_overlap_rereads_recent_window(spark):
    df = spark.createDataFrame([(1, dt.datetime(2023, 12, 31, 23)), (2, dt.datetime(2023, 12, 30))],
                               "id int, ts timestamp_ntz")
    strict = incremental.newer_than_mark(df, "ts", MARK)
    late = incremental.newer_than_mark(df, "ts", MARK, lateness=dt.timedelta(hours=2))
    assert strict.count() == 0
    assert [r[0] for r in late.collect()] == [1]
