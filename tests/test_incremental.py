"""Incremental landing, drifted pages, canonical payloads, ordered files and change-driven marts."""

from __future__ import annotations

import datetime as dt

import pyarrow.parquet as pq
import pytest
from conftest import make_issue, write_pages
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.plans import metrics, pipeline
from tidemark.sources import landing
from tidemark.sources.storage import Lake
from tidemark.streaming import incremental

DAY = dt.datetime(2030, 5, 1)


def land(spark, lake_dirs, run_id, pages, name="w", since=None, all_stages=False):
    new_pages, base = lake_dirs
    folder = new_pages()
    write_pages(folder, "o", name, run_id, pages)
    if all_stages:
        pipeline.run_all(spark, str(folder), base, DAY, since)
    else:
        pipeline.land(spark, str(folder), base, DAY, since)
    return base


def ids(df):
    return sorted(r.issue_id for r in df.select("issue_id").collect())


def test_landing_leaves_out_what_was_updated_before_since(spark, lake_dirs):
    pages = [[make_issue(1, updated_at="2020-01-01T00:00:00Z"), make_issue(2, updated_at="2023-01-01T00:00:00Z")],
             [make_issue(3, updated_at="2019-01-01T00:00:00Z"), make_issue(4, updated_at="soon")]]
    base = land(spark, lake_dirs, "r", pages, since=dt.datetime(2023, 1, 1))
    assert ids(Lake(spark, base).read_bronze()) == [2, 4]  # a time that cannot be read is no reason to drop a record
    row = Lake(spark, base).read_manifests().first()
    assert (row.since, row.pages_fetched, row.records_fetched) == (dt.datetime(2023, 1, 1), 2, 2)


def test_each_repository_lands_from_its_own_watermark(spark, lake_dirs):
    land(spark, lake_dirs, "r1", [[make_issue(1, updated_at="2024-03-31T00:00:00Z")]], name="a", all_stages=True)
    old = [[make_issue(2, updated_at="2024-01-01T00:00:00Z"), make_issue(3, updated_at="2024-03-01T00:00:00Z")]]
    land(spark, lake_dirs, "r2", old, name="a", all_stages=True)  # from 2024-03-01, 30 days before
    base = land(spark, lake_dirs, "r2", old, name="b", all_stages=True)  # never synced: all
    current = Lake(spark, base).silver("issue_current")
    assert ids(current.filter("repo_name = 'a'")) == [1, 3] and ids(current.filter("repo_name = 'b'")) == [2, 3]
    land(spark, lake_dirs, "r3", old, name="a", since=dt.datetime(1970, 1, 1), all_stages=True)  # a backfill
    assert ids(Lake(spark, base).silver("issue_current").filter("repo_name = 'a'")) == [1, 2, 3]


def test_silver_without_a_run_is_an_error_and_with_nothing_new_writes_nothing(spark, lake_dirs):
    with pytest.raises(pipeline.NoSuccessfulRun):
        pipeline.build_silver(spark, lake_dirs[1], DAY)
    base = land(spark, lake_dirs, "r", [[make_issue(1)]])
    with pytest.raises(pipeline.NoSuccessfulRun, match="o/other"):
        pipeline.build_silver(spark, base, DAY, [("o", "w"), ("o", "other")])
    assert pipeline.build_silver(spark, base, DAY).count() == 1
    assert pipeline.build_silver(spark, base, DAY).count() == 0
    assert spark.read.parquet(Lake(spark, base).sync_log).count() == 1


def test_runs_with_drifted_files_are_merged(spark, lake_dirs):
    base = land(spark, lake_dirs, "r1", [[make_issue(1, updated_at="2024-01-01T00:00:00Z")]])
    lake = Lake(spark, base)
    drifted = lake.read_bronze().select(
        "repo_owner", "repo_name", "run_id", F.col("page_number").cast("string").alias("page_number"),
        F.lit("2024-06-01T00:00:00Z").alias("fetched_at"), F.lit("2").alias("issue_id"),
        F.replace("payload_json", F.lit('"id":1,'), F.lit('"id":2,')).alias("payload_json"))
    drifted.write.mode("append").partitionBy("repo_owner", "repo_name", "run_id").parquet(lake.bronze)
    pipeline.build_silver(spark, base, DAY)
    got = {r.issue_id: r.source_recorded_at for r in lake.silver("issue_current").collect()}
    assert sorted(got) == [1, 2] and got[2] == dt.datetime(2024, 6, 1)


def test_key_order_does_not_matter(spark):
    texts = ['{"id": 1, "user": {"id": 2, "login": "x"}, "labels": []}', '{"labels":[],"user":{"login":"x","id":2},"id":1}']
    pages = spark.createDataFrame([("r", "o", "n", k, DAY, [t]) for k, t in enumerate(texts)],
                                  "run_id string, repo_owner string, repo_name string, page_number int, fetched_at timestamp, records array<string>")
    found = {r.payload_json for r in landing.bronze_rows(pages).collect()}
    assert found == {'{"id":1,"labels":[],"user":{"id":2,"login":"x"}}'}
    odd = spark.createDataFrame([("not json",), (None,)], "t string")
    from tidemark import functions as tf
    assert [r[0] for r in odd.select(tf.canonical_json("t")).collect()] == ["not json", None]


def test_unchanged_repositories_keep_their_marts(spark, lake_dirs):
    land(spark, lake_dirs, "r1", [[make_issue(1)]], name="a", all_stages=True)
    base = land(spark, lake_dirs, "r1", [[make_issue(2)]], name="b", all_stages=True)
    version = lambda: {r.repo_name: r.version for r in Lake(spark, base).gold_commits().collect()}
    before = version()
    pipeline.build_gold(spark, base, DAY)
    assert version() == before and spark.read.parquet(Lake(spark, base).gold_log).count() == 2
    land(spark, lake_dirs, "r2", [[make_issue(3)]], name="b", all_stages=True)
    after = version()
    assert after["a"] == before["a"] and after["b"] > before["b"]
    pipeline.build_gold(spark, base, DAY, everything=True)
    assert version()["a"] > before["a"]


def test_mart_files_are_in_order_and_filters_reach_them(spark, lake_dirs):
    pages = [[make_issue(k, created_at=f"2024-01-{(k * 5) % 28 + 1:02d}T00:00:00Z") for k in range(1, 29)]]
    base = land(spark, lake_dirs, "r", pages, all_stages=True)
    lake = Lake(spark, base)
    for table, column in (("mart_issue_lifecycle", "created_date"), ("mart_issue_daily_flow", "calendar_date")):
        for file in [f for f in lake.gold(table).inputFiles() if table in f]:
            days = pq.read_table(file.removeprefix("file://"), partitioning=None)[column].to_pylist()
            assert days == sorted(days)
    opened = metrics.opened_in_window(lake.gold("mart_issue_lifecycle"), "2024-01-28", 10, lake.gold_commits())
    assert opened.first().opened_in_window == 11
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_date" in plan
    quiet = metrics.opened_in_window(lake.gold("mart_issue_lifecycle"), "2031-01-01", 10, lake.gold_commits())
    assert quiet.first().opened_in_window == 0


def test_top_k_comes_in_order_and_does_not_depend_on_the_dealing(spark):
    rows = [("hot", i % 97, i) for i in range(3000)] + [("cold", 1, 1)]
    df = spark.createDataFrame(rows, "k string, v int, id int")
    want = [("cold", 1, 1)] + sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-r[1], r[2]))[:5]
    for parts in (1, 7):
        got = ops.top_k_per_group(df.repartition(9), ["k"], [F.col("v").desc(), F.col("id")], 5, parts)
        assert [tuple(r) for r in got.collect()] == want


def test_stream_without_rows_gives_an_empty_table(spark, workdir):
    (workdir / "none").mkdir()
    stream = spark.readStream.schema("event_type string, ts timestamp").parquet(str(workdir / "none"))
    got = incremental.run_daily_counts(spark, stream, ["event_type"], "ts")
    assert got.columns == ["event_type", "calendar_date", "event_count"] and got.count() == 0


def test_snapshot_folds_batches_and_leaves_replayed_ones_alone(spark, workdir):
    sink = incremental.SnapshotSink(str(workdir / "snap"), ["k"], ["v"], fold=4)
    assert sink.current(spark) is None
    for batch in range(10):
        sink(spark.createDataFrame([(i % 5, batch * 10 + i) for i in range(10)], "k int, v int"), batch)
    want = {(k, 95 + k) for k in range(5)}
    assert {tuple(r) for r in sink.current(spark).collect()} == want
    read = {f.split("snap/")[1].rsplit("/", 1)[0] for f in sink.current(spark).inputFiles()}
    assert read == {"base/covered=7", "data/batch=8", "data/batch=9"}
    sink(spark.createDataFrame([(0, 1000)], "k int, v int"), 9)
    assert {tuple(r) for r in sink.current(spark).collect()} == want
