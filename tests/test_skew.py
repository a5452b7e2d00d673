"""A repository holding most of the issues: results equal brute force, and no
row-level shuffle is keyed by repository alone."""

from __future__ import annotations

import collections
import datetime as dt
import random
import re

from pyspark.sql import functions as F

from tidemark.plans import marts, metrics

RUN_TS = dt.datetime(2024, 3, 1)


def _fixture(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        repo = "hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", "c"])
        created = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 40), hours=rnd.randint(0, 23))
        closed = created + dt.timedelta(days=rnd.randint(0, 20)) if rnd.random() < 0.5 else None
        rows.append((i, "o", repo, "closed" if closed else "open", created, closed, rnd.random() < 0.1))
    df = spark.createDataFrame(
        rows, "issue_id long, repo_owner string, repo_name string, state string, created_at timestamp, "
        "closed_at timestamp, is_pull_request boolean",
    ).select(
        "issue_id", F.col("issue_id").cast("string").alias("issue_node_id"), "repo_owner", "repo_name",
        F.col("issue_id").alias("issue_number"), F.lit("t").alias("title"), F.lit("u").alias("html_url"), "state",
        F.lit(None).cast("string").alias("state_reason"), "created_at", "closed_at",
        F.coalesce("closed_at", "created_at").alias("updated_at"), F.lit("NONE").alias("author_association"),
        F.lit(0).cast("bigint").alias("comment_count"), "is_pull_request",
    )
    lab = spark.createDataFrame([], "repo_owner string, repo_name string, issue_id long, label_name string")
    asg = spark.createDataFrame([], "repo_owner string, repo_name string, issue_id long, assignee_login string")
    return rows, marts.lifecycle(df, lab, asg, RUN_TS)


def test_hot_repository_daily_flow_matches_brute_force(spark):
    rows, lc = _fixture(spark)
    flow = {(r.repo_name, r.calendar_date): r for r in marts.daily_flow(lc).collect()}
    opened, closed = collections.Counter(), collections.Counter()
    for _, _, repo, state, created, closed_at, pr in rows:
        if pr:
            continue
        opened[(repo, created.date())] += 1
        if state == "closed" and closed_at is not None:
            closed[(repo, closed_at.date())] += 1
    for repo in ["hot", "a", "b", "c"]:
        days = [d for (r, d) in list(opened) + list(closed) if r == repo]
        lo, hi = min(days), max(days)
        running = 0
        window = []
        for k in range((hi - lo).days + 1):
            d = lo + dt.timedelta(days=k)
            got = flow[(repo, d)]
            net = opened[(repo, d)] - closed[(repo, d)]
            running += net
            window = (window + [opened[(repo, d)]])[-7:]
            assert (got.opened_count, got.closed_count, got.net_change) == (opened[(repo, d)], closed[(repo, d)], net)
            assert got.cumulative_net_change == running and got.rolling_7d_opened == sum(window)
        assert len([1 for (r, _) in flow if r == repo]) == (hi - lo).days + 1


def test_hot_repository_top_k_and_counts(spark):
    rows, lc = _fixture(spark)
    top = metrics.issue_detail(lc, k=25).filter(F.col("repo_name") == "hot").collect()
    want = sorted(
        [(c, i) for i, _, r, _, c, _, pr in rows if r == "hot" and not pr], key=lambda x: (x[0], x[1]), reverse=True
    )[:25]
    assert [(r.created_at, r.issue_id) for r in top] == sorted(want, key=lambda x: (x[0], x[1]), reverse=True)
    got = {r.repo_name: r.opened_in_window for r in metrics.opened_in_window(lc, "2024-02-10", days=10).collect()}
    assert got["hot"] == sum(
        1 for _, _, r, _, c, _, pr in rows if r == "hot" and not pr and c.date() >= dt.date(2024, 1, 31)
    )


def test_no_row_level_shuffle_keyed_by_repository_alone(spark):
    """Every exchange on (repo_owner, repo_name) only must sit above an aggregation
    (days or per-repo partials), never directly above issue rows."""
    _, lc = _fixture(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = 0
        for df in [marts.daily_flow(lc), metrics.opened_in_window(lc, "2024-02-10"), marts.weekday_rhythm(lc)]:
            plan = df._jdf.queryExecution().executedPlan().toString()
            lines = plan.splitlines()
            for i, line in enumerate(lines):
                if re.search(r"Exchange hashpartitioning\(repo_owner#\d+, repo_name#\d+, \d+\)", line):
                    seen += 1
                    assert "HashAggregate" in lines[i + 1], plan
        assert seen >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
