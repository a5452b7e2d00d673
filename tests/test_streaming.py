"""Stream results equal the batch results."""

from __future__ import annotations

import datetime as dt
import os

from conftest import SF_SMALL, make_issue, write_pages
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.plans import pipeline
from tidemark.schemas import ISSUE_KEYS
from tidemark.sources import tables
from tidemark.sources.storage import Lake
from tidemark.streaming import incremental


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _versions(spark):
    return tables.event_versions(spark, SF_SMALL).select(*ISSUE_KEYS, "updated_at", "event_id", "value")


def test_daily_counts_stream_equals_batch(spark):
    ev = tables.table(spark, SF_SMALL, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    schema = tables.table(spark, SF_SMALL, "events").schema
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
        .select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    )
    got = incremental.run_daily_counts(spark, stream, ["event_type"], "ts")
    want = ops.daily_event_counts(ev, ["event_type"], {"event_count": F.to_date("ts")})
    assert _rows(got.select("event_type", "calendar_date", "event_count")) == _rows(
        want.select("event_type", "calendar_date", "event_count")
    )


def test_daily_counts_stream_counts_late_rows(spark, workdir):
    """A file for each batch, whose dates go backwards by far more than a week."""
    src = str(workdir / "src")
    for n, day in enumerate(["2024-06-30", "2024-05-01", "2024-05-01", "2024-01-01"]):
        rows = [("a", dt.datetime.fromisoformat(f"{day} 0{h}:00:00")) for h in range(3)]
        spark.createDataFrame(rows, "event_type string, ts timestamp").coalesce(1).write.parquet(f"{src}/{n}")
        for f in (workdir / "src" / str(n)).glob("part-*"):  # oldest file first
            os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    stream = spark.readStream.schema("event_type string, ts timestamp").option("recursiveFileLookup", True).option(
        "maxFilesPerTrigger", 1).parquet(src)
    got = {str(r.calendar_date): r.event_count for r in incremental.run_daily_counts(spark, stream, ["event_type"], "ts").collect()}
    assert got == {"2024-06-30": 3, "2024-05-01": 6, "2024-01-01": 3}


def test_upsert_stream_over_out_of_order_batches_equals_one_pass(spark, workdir):
    """Newest slice arrives first, oldest last; the snapshot still keeps the latest."""
    versions = _versions(spark)
    src = str(workdir / "src")
    cuts = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 1)]
    slices = list(zip(cuts[:-1], cuts[1:]))[::-1]
    for i, (lo, hi) in enumerate(slices):
        part = versions.filter((F.col("updated_at") >= F.lit(lo)) & (F.col("updated_at") < F.lit(hi)))
        part.coalesce(1).write.parquet(f"{src}/batch_{i}")
    stream = spark.readStream.schema(versions.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True).parquet(src)
    sink = incremental.SnapshotSink(str(workdir / "snap"), ISSUE_KEYS, ["updated_at", "event_id"])
    q = incremental.upsert_stream(stream, sink, str(workdir / "ckpt"))
    q.awaitTermination()
    assert q.lastProgress is not None
    commits = spark.read.parquet(str(workdir / "snap" / "commits")).count()
    assert commits >= 3  # one micro-batch per file
    want = ops.latest_by_key(versions, ISSUE_KEYS, [F.col("updated_at").desc(), F.col("event_id").desc()])
    assert _rows(sink.current(spark)) == _rows(want)


def test_upsert_stream_restart_is_idempotent(spark, workdir):
    versions = _versions(spark)
    src = str(workdir / "src")
    versions.coalesce(1).write.parquet(f"{src}/a")
    sink = incremental.SnapshotSink(str(workdir / "snap"), ISSUE_KEYS, ["updated_at", "event_id"])
    stream = spark.readStream.schema(versions.schema).option("recursiveFileLookup", True).parquet(src)
    incremental.upsert_stream(stream, sink, str(workdir / "ckpt")).awaitTermination()
    first = _rows(sink.current(spark))
    # restart from the same checkpoint: nothing new, same snapshot
    incremental.upsert_stream(stream, sink, str(workdir / "ckpt")).awaitTermination()
    assert _rows(sink.current(spark)) == first


def test_manifest_driven_silver_stream_matches_batch(spark, lake_dirs, workdir):
    new_pages, base = lake_dirs
    d1 = new_pages()
    write_pages(d1, "acme", "widgets", "r1", [[make_issue(1, title="v1"), make_issue(2)]])
    pipeline.land(spark, str(d1), base, dt.datetime(2024, 1, 1, 0, 5))
    q = incremental.manifest_driven_silver(spark, base, str(workdir / "ckpt"))
    q.awaitTermination()
    d2 = new_pages()
    write_pages(d2, "acme", "widgets", "r2", [[make_issue(1, title="v2", updated_at="2024-01-02T00:00:00Z")]])
    pipeline.land(spark, str(d2), base, dt.datetime(2024, 1, 2, 0, 5))
    incremental.manifest_driven_silver(spark, base, str(workdir / "ckpt")).awaitTermination()
    rows = {r.issue_id: r.title for r in Lake(spark, base).silver("issue_current").collect()}
    assert rows == {1: "v2", 2: "entry 2"}
    state = Lake(spark, base).sync_state().collect()
    assert [s.last_successful_bronze_run_id for s in state] == ["r2"]
    report = pipeline.check_report(spark, base, "silver").collect()
    assert all(r.violations == 0 for r in report)


def test_snapshot_sink_compaction(spark, workdir):
    versions = _versions(spark)
    src = str(workdir / "src")
    cut = dt.datetime(2024, 1, 3)
    versions.filter(F.col("updated_at") < F.lit(cut)).coalesce(1).write.parquet(f"{src}/a")
    sink = incremental.SnapshotSink(str(workdir / "snap"), ISSUE_KEYS, ["updated_at", "event_id"])
    stream = lambda: spark.readStream.schema(versions.schema).option("recursiveFileLookup", True).parquet(src)
    incremental.upsert_stream(stream(), sink, str(workdir / "ckpt")).awaitTermination()
    sink.compact(spark)
    versions.filter(F.col("updated_at") >= F.lit(cut)).coalesce(1).write.parquet(f"{src}/b")
    incremental.upsert_stream(stream(), sink, str(workdir / "ckpt")).awaitTermination()
    want = ops.latest_by_key(versions, ISSUE_KEYS, [F.col("updated_at").desc(), F.col("event_id").desc()])
    assert _rows(sink.current(spark)) == _rows(want)
