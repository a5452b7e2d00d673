"""Edge cases the reference leaves untested (FIXTURES section 6) and exact mart values."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import make_issue
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark import operators as ops
from tidemark.plans import marts, metrics, quality, silver

RUN_TS = dt.datetime(2024, 2, 1)
KEYS = ["repo_owner", "repo_name", "issue_id"]


def bronze(spark, records, owner="acme", name="widgets", run_id="r1", page=1):
    rows = []
    for r in records:
        text = r if isinstance(r, str) else json.dumps(r)
        rid = r.get("id") if isinstance(r, dict) else None
        rows.append((run_id, owner, name, page, dt.datetime(2024, 1, 1), rid, None, text))
    return spark.createDataFrame(
        rows,
        "run_id string, repo_owner string, repo_name string, page_number int, fetched_at timestamp, "
        "issue_id long, issue_updated_at timestamp, payload_json string",
    )


def flat(spark, records):
    return {r.issue_id: r for r in silver.flatten(bronze(spark, records), RUN_TS).collect()}


# ---------------------------------------------------------------- flatten


def test_json_nulls_and_key_presence(spark):
    a = make_issue(1, labels=None, assignees=None)
    a["labels"] = None
    a["assignees"] = None
    a["user"] = None
    b = make_issue(2)
    b["pull_request"] = None  # key present with JSON null: still a pull request
    c = make_issue(3, is_pull_request=True)
    rows = flat(spark, [a, b, c])
    assert rows[1].assignee_count == 0 and rows[1].author_login is None
    assert rows[1].is_pull_request is False
    assert rows[2].is_pull_request is True and rows[2].pull_request_url is None
    assert rows[3].is_pull_request is True and rows[3].pull_request_url == c["pull_request"]["url"]


def test_bad_fields_null_but_row_survives(spark):
    a = make_issue(1, created_at="not a time")
    a["comments"] = "many"
    a["number"] = "x1"
    rows = flat(spark, [a])
    assert rows[1].created_at is None and rows[1].comment_count is None and rows[1].issue_number is None
    assert rows[1].title == "entry 1"


def test_malformed_payload_keeps_id_and_drops_missing_id(spark):
    df = bronze(spark, ['{"id": 5, "title": ', '{"title": "no id"}'])
    df = df.withColumn("issue_id", F.when(F.col("payload_json").startswith('{"id": 5'), F.lit(5)))
    rows = silver.flatten(df, RUN_TS).collect()
    assert [r.issue_id for r in rows] == [5]
    assert rows[0].title is None


def test_timestamp_forms_parse_as_utc(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00+00:00",), ("2024-01-01 10:00:00",), ("junk",)], "s string")
    got = [r[0] for r in df.select(tf.try_timestamp("s")).collect()]
    assert got[:3] == [dt.datetime(2024, 1, 1, 10)] * 3 and got[3] is None


# ---------------------------------------------------------------- children


def test_children_rules(spark):
    labels = [
        {"id": 10, "name": "bug", "description": "d", "color": "f00", "default": False},
        {"id": 10, "name": "bug", "description": "d", "color": "f00", "default": False},  # duplicate
        {"id": "abc", "name": "weird-id", "description": None, "color": None, "default": True},
        {"id": 12, "name": None},  # label without a name
        {"name": "no-id"},  # dropped: no id
        "not-an-object",
    ]
    assignees = [{"login": "alice", "id": 1, "type": "User"}, {"id": 2, "type": "User"}]
    cur = silver.flatten(bronze(spark, [make_issue(1, labels=labels, assignees=assignees)]), RUN_TS)
    lab = sorted(((r.label_id, r.label_name) for r in silver.labels_of(cur, RUN_TS).collect()), key=str)
    assert lab == sorted([(10, "bug"), (None, "weird-id"), (12, None)], key=str)
    asg = [r.assignee_login for r in silver.assignees_of(cur, RUN_TS).collect()]
    assert asg == ["alice"]


def test_sorted_list_keeps_nulls_last(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a")], "k int, v string")
    got = df.groupBy("k").agg(tf.sorted_list("v").alias("l")).collect()[0].l
    assert got == ["a", "b", None]


# ---------------------------------------------------------------- merge


def test_merge_order_invariance(spark):
    """Merging deltas one by one, in any order, equals one pass over all of them."""
    v = tf  # noqa: F841
    recs = [
        make_issue(1, title="a", updated_at="2024-01-01T00:00:00Z"),
        make_issue(1, title="b", updated_at="2024-01-03T00:00:00Z"),
        make_issue(1, title="c", updated_at="2024-01-02T00:00:00Z"),
        make_issue(2, title="x", updated_at="2024-01-02T00:00:00Z"),
    ]
    batches = [silver.flatten(bronze(spark, [r], run_id=f"r{i}"), RUN_TS) for i, r in enumerate(recs)]
    one_pass = silver.merge_current(None, batches[0].unionByName(batches[1]).unionByName(batches[2]).unionByName(batches[3]), RUN_TS)
    for order in ([0, 1, 2, 3], [3, 2, 1, 0], [1, 3, 0, 2]):
        cur = None
        for i in order:
            cur = silver.merge_current(cur, batches[i], RUN_TS)
        assert {r.issue_id: r.title for r in cur.collect()} == {r.issue_id: r.title for r in one_pass.collect()} == {1: "b", 2: "x"}


# ---------------------------------------------------------------- marts


def _issues(spark, rows):
    return spark.createDataFrame(
        rows,
        "issue_id long, repo_owner string, repo_name string, state string, created_at timestamp, "
        "closed_at timestamp, is_pull_request boolean",
    ).select(
        "issue_id", F.concat(F.lit("N"), F.col("issue_id").cast("string")).alias("issue_node_id"), "repo_owner", "repo_name",
        F.col("issue_id").alias("issue_number"), F.lit("t").alias("title"), F.lit("u").alias("html_url"), "state",
        F.lit(None).cast("string").alias("state_reason"), "created_at", "closed_at",
        F.coalesce("closed_at", "created_at").alias("updated_at"), F.lit("NONE").alias("author_association"),
        F.lit(0).cast("bigint").alias("comment_count"), "is_pull_request",
    )


def _empty_children(spark):
    lab = spark.createDataFrame([], "repo_owner string, repo_name string, issue_id long, label_name string")
    asg = spark.createDataFrame([], "repo_owner string, repo_name string, issue_id long, assignee_login string")
    return lab, asg


def test_closure_age_counts_calendar_days_and_open_with_closed_at(spark):
    t = dt.datetime
    iss = _issues(spark, [
        (1, "o", "r", "closed", t(2024, 1, 1, 23, 55), t(2024, 1, 2, 0, 5), False),  # across midnight: 1
        (2, "o", "r", "open", t(2024, 1, 1), t(2024, 1, 5), False),  # open with closed_at: age, not closed
        (3, "o", "r", "closed", t(2024, 1, 10), t(2024, 1, 1), False),  # negative age
    ])
    lc = {r.issue_id: r for r in marts.lifecycle(iss, *_empty_children(spark), RUN_TS).collect()}
    assert lc[1].closure_age_days == 1 and lc[2].closure_age_days == 4 and lc[3].closure_age_days == -9
    assert lc[2].is_closed is False and lc[1].label_group == "other" and lc[1].label_names == []
    flow = {str(r.calendar_date): r for r in marts.daily_flow(marts.lifecycle(iss, *_empty_children(spark), RUN_TS)).collect()}
    assert flow["2024-01-05"].closed_count == 0  # open issue is not counted closed
    monthly = marts.closure_age_monthly(marts.lifecycle(iss, *_empty_children(spark), RUN_TS)).collect()
    assert monthly[0].closed_issue_count == 2 and monthly[0].share_closed_within_7d == 1.0


def test_closed_before_created_tolerance(spark):
    t = dt.datetime
    iss = _issues(spark, [
        (1, "o", "r", "closed", t(2024, 1, 1, 12, 0), t(2024, 1, 1, 11, 1), False),  # 59 min early: ok
        (2, "o", "r", "closed", t(2024, 1, 1, 12, 0), t(2024, 1, 1, 10, 59), False),  # 61 min early: violation
    ])
    got = quality.closed_before_created(iss).collect()
    assert [(r.repo_owner, r.violations) for r in got] == [("o", 1)]


def test_swing_rank_ties_and_top_k_with_ties(spark):
    flow = spark.createDataFrame(
        [("o", "r", dt.date(2024, 1, d), o, 0, o) for d, o in [(1, 3), (2, 3), (3, 1), (4, 0)]],
        "repo_owner string, repo_name string, calendar_date date, opened_count long, closed_count long, net_change long",
    )
    sw = {r.calendar_date.day: r for r in marts.swing_days(flow).collect()}
    assert (sw[1].swing_rank_positive, sw[2].swing_rank_positive, sw[3].swing_rank_positive) == (1, 1, 3)
    assert sw[4].swing_rank_negative == 1
    top = metrics.top_swing_days(marts.swing_days(flow), "positive", k=1).collect()
    assert len(top) == 2  # ties enlarge the top-k


def test_weekday_names_monday_first(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")  # Mon, Sun
    got = df.select(tf.weekday_num("d").alias("n"), tf.weekday_name(tf.weekday_num("d")).alias("w")).collect()
    assert [(r.n, r.w) for r in got] == [(0, "Monday"), (6, "Sunday")]


def test_direction_signal_thresholds(spark):
    df = spark.createDataFrame([(11,), (10,), (-10,), (-11,), (None,)], "n long")
    assert [r[0] for r in df.select(tf.direction_signal("n")).collect()] == ["Worsening", "Flat", "Flat", "Improving", "Flat"]


def test_dense_spine_per_repo_and_rolling(spark):
    t = dt.datetime
    iss = _issues(spark, [
        (1, "o", "a", "open", t(2024, 1, 1), None, False),
        (2, "o", "a", "open", t(2024, 1, 10), None, False),
        (3, "o", "007", "closed", t(2024, 1, 2), t(2024, 1, 3), False),
        (4, "o", "007", "open", t(2024, 1, 2), None, True),  # pull request: excluded
    ])
    lc = marts.lifecycle(iss, *_empty_children(spark), RUN_TS)
    flow = marts.daily_flow(lc).collect()
    a = [r for r in flow if r.repo_name == "a"]
    b = [r for r in flow if r.repo_name == "007"]
    assert len(a) == 10 and len(b) == 2
    assert a[-1].rolling_7d_opened == 1 and a[-1].cumulative_net_change == 2
    assert [(r.opened_count, r.closed_count, r.cumulative_net_change) for r in sorted(b, key=lambda r: r.calendar_date)] == [(1, 0, 1), (0, 1, 0)]
    assert quality.spine_gaps(marts.daily_flow(lc)).count() == 0


def test_scope_filters(spark):
    t = dt.datetime
    iss = _issues(spark, [(1, "o", "a", "open", t(2024, 1, 1), None, False), (2, "o", "b", "open", t(2024, 3, 1), None, False)])
    lc = marts.lifecycle(iss, *_empty_children(spark), RUN_TS)
    assert metrics.scope(lc, repo=("o", "a")).count() == 1
    assert metrics.scope(lc, date_col="created_date", start="2024-02-01").count() == 1
    assert metrics.scope(lc, label_group="other").count() == 2


def test_display_names(spark):
    df = spark.createDataFrame([(1, 2)], "issue_number long, closure_age_days long")
    assert metrics.display(df).columns == ["Issue #", "Closure Age (days)"]


def test_latest_by_key_uses_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    out = ops.latest_by_key(df, ["k"], [F.col("v").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r.v for r in out.collect()) == [93, 94, 95, 96, 97, 98, 99]


def test_unknown_check_mode_raises(spark, workdir):
    from tidemark.plans import pipeline

    with pytest.raises(ValueError):
        pipeline.check_report(spark, str(workdir), "bronze")


# ---------------------------------------------------------------- files, views, SQL API


def test_files_helpers(spark, workdir):
    from tidemark.sources import files

    assert files.run_id_for(dt.datetime(2024, 1, 2, 3, 4, 5)) == "manual__2024-01-02T03-04-05Z"
    p = workdir / "page.json"
    p.write_text(json.dumps([make_issue(1), make_issue(2, is_pull_request=True)]))
    df = files.read_json_array(spark, str(p))
    assert df.count() == 2 and "pull_request" in df.columns
    assert files.export_parquet(df.select("id", "title"), str(workdir / "out")) == 2
    d = {r.col_name: r.data_type for r in files.describe(df.select("id", "title")).collect()}
    assert d == {"id": "bigint", "title": "string"}


def test_views_and_bound_sql(spark, lake_dirs):
    from conftest import write_pages

    from tidemark.plans import pipeline
    from tidemark.sources.storage import Lake

    new_pages, base = lake_dirs
    d = new_pages()
    write_pages(d, "acme", "w", "r1", [[make_issue(1, created_at="2024-01-20T00:00:00Z"), make_issue(2)]])
    pipeline.run_all(spark, str(d), base, dt.datetime(2024, 1, 21))
    lake = Lake(spark, base)
    lake.register_views()
    assert spark.table("silver_issue_current").count() == 2
    assert spark.table("gold_mart_issue_daily_flow").count() == 21
    assert spark.table("silver_sync_state").collect()[0].last_successful_bronze_run_id == "r1"
    got = metrics.opened_in_window_sql(spark, "gold_mart_issue_lifecycle", "acme", "w", "2024-01-21", days=5).collect()
    assert got[0].opened_in_window == 1
    metrics.register_open_backlog_view(lake.gold("mart_issue_lifecycle"))
    assert spark.table("v_open_backlog_snapshot").count() == 2
    hist = pipeline.manifest_history(spark, base).collect()
    assert [h.run_id for h in hist] == ["r1"]


# ---------------------------------------------------------------- exact mart and metric values


def test_weekday_rhythm_and_monthly_quantiles_exact(spark):
    t = dt.datetime
    iss = _issues(spark, [
        (1, "o", "r", "closed", t(2024, 1, 1), t(2024, 1, 2), False),  # Mon -> Tue, age 1
        (2, "o", "r", "closed", t(2024, 1, 1), t(2024, 1, 4), False),  # Mon -> Thu, age 3
        (3, "o", "r", "closed", t(2024, 1, 2), t(2024, 1, 12), False),  # Tue -> Fri, age 10
        (4, "o", "r", "closed", t(2023, 9, 1), t(2024, 1, 20), False),  # age 141
        (5, "o", "r", "open", t(2024, 1, 7), None, False),  # Sunday
    ])
    lc = marts.lifecycle(iss, *_empty_children(spark), RUN_TS)
    wk = {(r.event_type, r.weekday_name): r.issue_count for r in marts.weekday_rhythm(lc).collect()}
    assert wk == {
        ("opened", "Monday"): 2, ("opened", "Tuesday"): 1, ("opened", "Friday"): 1, ("opened", "Sunday"): 1,
        ("closed", "Tuesday"): 1, ("closed", "Thursday"): 1, ("closed", "Friday"): 1, ("closed", "Saturday"): 1,
    }
    m = marts.closure_age_monthly(lc).collect()
    assert len(m) == 1 and m[0].year_month == dt.date(2024, 1, 1)
    # ages 1, 3, 10, 141: lower median 3, p90 141
    assert (m[0].closed_issue_count, m[0].median_closure_age_days, m[0].p90_closure_age_days) == (4, 3, 141)
    assert (m[0].share_closed_within_7d, m[0].share_closed_after_90d) == (0.5, 0.25)
    avg = metrics.mean_share(marts.closure_age_monthly(lc), "share_closed_within_7d").collect()[0]
    assert avg.avg_share_closed_within_7d == 0.5


def test_window_boundary_is_inclusive(spark):
    t = dt.datetime
    as_of = dt.date(2024, 7, 1)
    start = as_of - dt.timedelta(days=180)
    iss = _issues(spark, [
        (1, "o", "r", "open", t(start.year, start.month, start.day), None, False),  # exactly as_of - 180
        (2, "o", "r", "open", t(start.year, start.month, start.day) - dt.timedelta(days=1), None, False),
        (3, "o", "r", "closed", t(2024, 6, 1), t(2024, 6, 20), False),
    ])
    lc = marts.lifecycle(iss, *_empty_children(spark), RUN_TS)
    assert metrics.opened_in_window(lc, as_of).collect()[0].opened_in_window == 2
    assert metrics.closed_in_window(lc, as_of).collect()[0].closed_in_window == 1
    flow = marts.daily_flow(lc)
    assert metrics.net_change_in_window(flow, as_of).collect()[0].net_change_in_window == 1
    assert metrics.backlog_direction(flow, as_of).collect()[0].direction == "Flat"
    series = metrics.cumulative_series(flow, as_of).collect()
    assert series[0].calendar_date == start and series[0].cumulative_net_change == 2  # counts from history start


def test_scale_settings_size_partitions_from_input():
    from tidemark.session import scale_settings

    s = scale_settings(100 * 1024**4)  # 100 TB
    assert int(s["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 * 1024**2)
    assert s["spark.sql.files.maxPartitionBytes"] == str(256 * 1024**2)
    assert int(scale_settings(10 * 1024**2)["spark.sql.shuffle.partitions"]) == 200  # floor for small inputs


def test_merge_ranks_the_whole_union(spark):
    """Rows of an old snapshot that a clean one never has (no id, twice the same key) do not survive a merge."""
    at = "2031-02-01T00:00:00Z"
    old = silver.flatten(bronze(spark, [make_issue(1, title="old", updated_at=at), make_issue(2, title="keep", updated_at=at)]), RUN_TS)
    lost = old.limit(1).withColumn("issue_id", F.lit(None).cast("long"))
    prior = old.unionByName(old).unionByName(lost).unionByName(lost)
    delta = silver.flatten(bronze(spark, [make_issue(1, title="new", updated_at="2031-02-03T00:00:00Z")], run_id="r2"), RUN_TS)
    got = silver.merge_current(prior, delta, RUN_TS).collect()
    assert sorted((r.issue_id or 0, r.title) for r in got if r.issue_id) == [(1, "new"), (2, "keep")] and len(got) == 3


def test_merged_runs_are_read_from_written_tables(spark):
    """The tasks of the merge hold the rows they rank, and not also the buffers of the joins that derive them."""
    from tidemark.plans import lake_queries

    merged = lake_queries.merge_current_runs(spark, "/root/testdata/sf0.001")
    assert "Join " not in merged._jdf.queryExecution().optimizedPlan().toString()


def test_monthly_quantiles_are_exact_in_large_groups(spark):
    n = 60_000
    lc = spark.range(n).select(
        F.lit("o").alias("repo_owner"), F.lit("r").alias("repo_name"), F.lit(True).alias("is_closed"),
        F.lit("2031-05-06").cast("date").alias("closed_date"), F.pmod(F.xxhash64("id"), F.lit(30011)).alias("closure_age_days"))
    ages = sorted(r[0] for r in lc.select("closure_age_days").collect())
    got = marts.closure_age_monthly(lc).first()
    assert (got.median_closure_age_days, got.p90_closure_age_days) == (ages[n // 2 - 1], ages[n * 9 // 10 - 1])
    assert got.closed_issue_count == n
