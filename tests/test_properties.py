"""Property: merging deltas one by one, in any order, equals one pass over all rows."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import operators as ops

KEYS = ["repo_owner", "repo_name", "issue_id"]
ORDER = ["updated_at", "event_id"]

version = st.tuples(
    st.sampled_from(["a", "b"]),  # repo
    st.integers(1, 4),  # issue id
    st.integers(0, 5),  # day (ties happen)
    st.integers(0, 10**6),  # unique-ish tie breaker
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(version, min_size=1, max_size=25, unique_by=lambda r: r[3]), parts=st.integers(1, 4), seed=st.randoms())
def test_incremental_merge_equals_one_pass(spark, rows, parts, seed):
    data = [("o", r, i, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), e) for r, i, d, e in rows]
    df = spark.createDataFrame(data, "repo_owner string, repo_name string, issue_id long, updated_at timestamp, event_id long")
    order = [F.col(c).desc() for c in ORDER]
    want = sorted(tuple(r) for r in ops.latest_by_key(df, KEYS, order).collect())
    batches = [data[i::parts] for i in range(parts)]
    seed.shuffle(batches)
    cur = None
    for b in batches:
        if not b:
            continue
        bdf = spark.createDataFrame(b, df.schema)
        cur = bdf if cur is None else cur.unionByName(bdf)
        cur = ops.latest_by_key(cur, KEYS, order)
    assert sorted(tuple(r) for r in cur.collect()) == want
