"""Operators against brute force in plain Python, on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import incremental
from tidemark.operators.dedup import latest_per_key, newest_first

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

records = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                             st.one_of(st.none(), st.integers(0, 5)),
                             st.integers(0, 10_000)),
                   max_size=12, unique_by=lambda r: r[2])


@settings(**SETTINGS)
@given(recs=records)
def test_latest_per_key_matches_brute_force(spark, recs):
    df = spark.createDataFrame(recs, "k string, t int, id int")
    got = sorted((tuple(r) for r in latest_per_key(df, ["k"], newest_first("t", "id")).collect()),
                 key=repr)
    best = {}
    for k, t, i in recs:
        rank = (t is not None, t if t is not None else 0, i)       # NULL time loses
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, i))
    assert got == sorted((v[1] for v in best.values()), key=repr)


times = st.lists(st.datetimes(min_value=dt.datetime(2023, 1, 1), max_value=dt.datetime(2025, 1, 1)),
                 max_size=10)


@settings(**SETTINGS)
@given(ts=times, prev=st.datetimes(min_value=dt.datetime(2023, 1, 1),
                                   max_value=dt.datetime(2025, 1, 1)))
def test_mark_never_moves_back_and_counts_exactly(spark, ts, prev):
    prev = prev.replace(microsecond=0)
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    row = incremental.advance(df, "ts", prev.isoformat()).first()
    newer = [t for t in ts if t > prev]
    assert row["new_mark"] == max([prev] + newer)
    assert row["accepted"] == len(newer) and row["has_new"] == bool(newer)
