from tidemark.operators import kpi
from tests.conftest import rows

FACT = "media_id string, visitor_id string, browser string"


def test_null_group_kept_by_sql_and_dropped_by_dashboard(spark):
    fact = spark.createDataFrame([("m1", "v1", "x"), ("m1", "v2", "x"), ("m1", "v1", "x"),
                                  (None, "v3", "x"), ("m2", None, "x")], FACT)
    sql_style = kpi.distinct_visitors(fact, ["media_id"])
    assert rows(sql_style) == [("m1", 2), ("m2", 0), (None, 1)]
    dash = kpi.distinct_visitors(fact, ["media_id"], out="unique_visitors",
                                 drop_null_keys=True, order="key")
    assert [tuple(r) for r in dash.collect()] == [("m1", 2), ("m2", 0)]


def test_channel_counts_visitor_once_per_channel(spark):
    fact = spark.createDataFrame([("m1", "v1", "x"), ("m2", "v1", "x"), ("m3", "v2", "x"),
                                  ("m9", "v3", "x")], FACT)
    dim = spark.createDataFrame([("m1", "Facebook"), ("m2", "Facebook"), ("m3", "YouTube")],
                                "media_id string, channel string")
    assert rows(kpi.visitors_by_channel(fact, dim)) == [("Facebook", 1), ("YouTube", 1),
                                                        (None, 1)]


def test_top_videos_inner_join_order_and_limit(spark):
    fm = spark.createDataFrame([("m1", 1.5, 10), ("m2", 2.5, 30), ("m3", 0.5, 30),
                                ("gone", 9.0, 99)],
                               "media_id string, total_hours_watched double, play_count long")
    dim = spark.createDataFrame([("m1", "t1", "Unknown"), ("m2", "t2", "YouTube"),
                                 ("m3", "t3", "Facebook")],
                                "media_id string, title string, channel string")
    top = kpi.top_videos(fm, dim)
    assert [r["media_id"] for r in top.collect()] == ["m2", "m3", "m1"]
    assert [r["media_id"] for r in kpi.top_videos(fm, dim, n=1).collect()] == ["m2"]
    series = kpi.chart_series(top, "media_id")
    assert series.columns == ["media_id", "total_hours_watched"]   # first numeric, not the sort key
    assert kpi.chart_series(top, "browser") is None


def test_totals_and_missing_columns(spark):
    fact = spark.createDataFrame([("m1", "v1", "x"), ("m1", None, "x"), (None, "v2", "x")], FACT)
    assert tuple(kpi.totals(fact).first()) == (3, 1, 2)
    assert tuple(kpi.totals(fact.drop("visitor_id")).first()) == (3, 1, 0)
