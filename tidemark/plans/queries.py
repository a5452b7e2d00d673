"""Registered queries: each takes ``(spark, sf_dir)`` and returns a lazy DataFrame.

They run the library's plans over the driver's tables (see
``tidemark.sources.tables`` for the issue mapping). ``__spark_entry__`` exposes
them together with the oracle SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark import operators as ops
from tidemark.plans import marts
from tidemark.schemas import ISSUE_KEYS
from tidemark.session import configure
from tidemark.sources import tables

# The report date and load time used by every registered query
# (never the clock, so results repeat).
AS_OF = dt.date(2001, 8, 1)
RUN_TS = dt.datetime(2001, 8, 1, 0, 0, 0)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run

    return wrap


# --------------------------------------------------------------------------
# Silver inputs and the lifecycle mart
# --------------------------------------------------------------------------


def silver(spark: SparkSession, sf_dir: str):
    return (
        tables.issues(spark, sf_dir),
        tables.issue_labels(spark, sf_dir),
        tables.issue_assignees(spark, sf_dir),
    )


def lifecycle_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.lifecycle(*silver(spark, sf_dir), RUN_TS)


@register("issue_base")
def issue_base(spark, sf_dir):
    """Issue snapshot rows derived from orders, customers and line items."""
    return tables.issues(spark, sf_dir)


@register("label_lists")
def label_lists(spark, sf_dir):
    """A4: sorted label names per issue and the first of them."""
    lists = ops.sorted_lists(tables.issue_labels(spark, sf_dir), ISSUE_KEYS, "label_name", "label_names")
    return lists.select(*ISSUE_KEYS, "label_names", tf.first_element("label_names").alias("first_label"))


@register("assignee_lists")
def assignee_lists(spark, sf_dir):
    """A5: sorted assignee logins per issue."""
    return ops.sorted_lists(
        tables.issue_assignees(spark, sf_dir), ISSUE_KEYS, "assignee_login", "assignee_logins"
    ).select(*ISSUE_KEYS, "assignee_logins")


@register("lifecycle")
def lifecycle(spark, sf_dir):
    """M1: issue lifecycle mart."""
    return lifecycle_of(spark, sf_dir)


# --------------------------------------------------------------------------
# Daily flow (flagship) and the marts built on the lifecycle
# --------------------------------------------------------------------------


@register("daily_flow")
def daily_flow(spark, sf_dir):
    """M2: dense daily opened/closed/net with running and 7-day rolling sums."""
    return marts.daily_flow(lifecycle_of(spark, sf_dir))


@register("date_spine")
def date_spine(spark, sf_dir):
    """Every day between each repository's first and last event day."""
    return ops.date_spine(marts.daily_counts(lifecycle_of(spark, sf_dir)), ["repo_owner", "repo_name"])


@register("closure_age_monthly")
def closure_age_monthly(spark, sf_dir):
    """M3: monthly closure age quantiles and shares."""
    return marts.closure_age_monthly(lifecycle_of(spark, sf_dir))


@register("weekday_rhythm")
def weekday_rhythm(spark, sf_dir):
    """M4: opened / closed per weekday."""
    return marts.weekday_rhythm(lifecycle_of(spark, sf_dir))


@register("swing_days")
def swing_days(spark, sf_dir):
    """M5: swing-day ranks in both directions."""
    return marts.swing_days(marts.daily_flow(lifecycle_of(spark, sf_dir)))


@register("events_rolling_7d")
def events_rolling_7d(spark, sf_dir):
    """W2-W5 on a second table: dense daily event counts per type with rolling sums."""
    ev = tables.table(spark, sf_dir, "events").select("event_type", F.to_date(F.col("ts").cast("timestamp")).alias("d"))
    daily = ops.daily_event_counts(ev, ["event_type"], {"event_count": F.col("d")})
    dense = ops.densify(daily, ["event_type"], ["event_count"])
    return ops.running_and_rolling(
        dense,
        ["event_type"],
        "calendar_date",
        running={"cumulative_events": "event_count"},
        rolling={"rolling_7d_events": "event_count"},
    )


# --------------------------------------------------------------------------
# Metric queries
# --------------------------------------------------------------------------

from tidemark.plans import metrics  # noqa: E402


@register("kpi_repo_name")
def kpi_repo_name(spark, sf_dir):
    """K1: repositories in the lifecycle mart."""
    return metrics.repo_names(lifecycle_of(spark, sf_dir))


@register("kpi_opened_in_window")
def kpi_opened_in_window(spark, sf_dir):
    """K2: opened in the last 180 days."""
    return metrics.opened_in_window(lifecycle_of(spark, sf_dir), AS_OF)


@register("kpi_closed_in_window")
def kpi_closed_in_window(spark, sf_dir):
    """K3: closed in the last 180 days."""
    return metrics.closed_in_window(lifecycle_of(spark, sf_dir), AS_OF)


@register("kpi_net_change_in_window")
def kpi_net_change_in_window(spark, sf_dir):
    """K4: net change in the last 180 days."""
    return metrics.net_change_in_window(marts.daily_flow(lifecycle_of(spark, sf_dir)), AS_OF)


@register("kpi_backlog_direction")
def kpi_backlog_direction(spark, sf_dir):
    """K5: Worsening / Improving / Flat."""
    return metrics.backlog_direction(marts.daily_flow(lifecycle_of(spark, sf_dir)), AS_OF)


@register("ts_cumulative_backlog")
def ts_cumulative_backlog(spark, sf_dir):
    """K6: cumulative net change series for the window."""
    return metrics.cumulative_series(marts.daily_flow(lifecycle_of(spark, sf_dir)), AS_OF)


@register("ts_7d_opened_vs_closed")
def ts_7d_opened_vs_closed(spark, sf_dir):
    """K7: rolling 7-day opened vs closed."""
    return metrics.rolling_opened_closed_series(marts.daily_flow(lifecycle_of(spark, sf_dir)), AS_OF)


@register("ts_7d_backlog_velocity")
def ts_7d_backlog_velocity(spark, sf_dir):
    """K8: rolling 7-day net change."""
    return metrics.rolling_net_series(marts.daily_flow(lifecycle_of(spark, sf_dir)), AS_OF)


@register("top_swing_positive")
def top_swing_positive(spark, sf_dir):
    """K9: top 10 positive swing days (ties kept)."""
    return metrics.top_swing_days(swing_days(spark, sf_dir), "positive")


@register("top_swing_negative")
def top_swing_negative(spark, sf_dir):
    """Top 10 negative swing days (ties kept)."""
    return metrics.top_swing_days(swing_days(spark, sf_dir), "negative")


@register("ts_monthly_closure_age")
def ts_monthly_closure_age(spark, sf_dir):
    """Monthly median / p90 closure age for the last two years."""
    return metrics.closure_age_series(closure_age_monthly(spark, sf_dir), AS_OF)


@register("kpi_share_closed_within_7d")
def kpi_share_closed_within_7d(spark, sf_dir):
    """Mean monthly share closed within 7 days."""
    return metrics.mean_share(closure_age_monthly(spark, sf_dir), "share_closed_within_7d")


@register("kpi_share_closed_after_90d")
def kpi_share_closed_after_90d(spark, sf_dir):
    """Mean monthly share closed after 90 days."""
    return metrics.mean_share(closure_age_monthly(spark, sf_dir), "share_closed_after_90d")


@register("bar_opened_by_weekday")
def bar_opened_by_weekday(spark, sf_dir):
    """Opened per weekday."""
    return metrics.weekday_bars(weekday_rhythm(spark, sf_dir), "opened")


@register("bar_closed_by_weekday")
def bar_closed_by_weekday(spark, sf_dir):
    """Closed per weekday."""
    return metrics.weekday_bars(weekday_rhythm(spark, sf_dir), "closed")


@register("issue_detail")
def issue_detail(spark, sf_dir):
    """Newest 500 issues per repository."""
    return metrics.issue_detail(lifecycle_of(spark, sf_dir))


@register("open_backlog_preview")
def open_backlog_preview(spark, sf_dir):
    """Ten most recently updated open issues per repository."""
    return metrics.open_backlog_preview(lifecycle_of(spark, sf_dir))


@register("count_by_state")
def count_by_state(spark, sf_dir):
    """Non-pull-request issues per state."""
    return metrics.count_by_state(tables.issues(spark, sf_dir))


@register("issue_totals")
def issue_totals(spark, sf_dir):
    """Total, pull-request and true-issue rows per repository."""
    return metrics.issue_totals(tables.issues(spark, sf_dir))


@register("label_breakdown")
def label_breakdown(spark, sf_dir):
    """Issues per label."""
    return metrics.list_breakdown(lifecycle_of(spark, sf_dir), "label_names", "label_name")


@register("assignee_breakdown")
def assignee_breakdown(spark, sf_dir):
    """Issues per assignee."""
    return metrics.list_breakdown(lifecycle_of(spark, sf_dir), "assignee_logins", "assignee_login")


@register("label_group_breakdown")
def label_group_breakdown(spark, sf_dir):
    """Issues per label group."""
    return metrics.label_group_breakdown(lifecycle_of(spark, sf_dir))


@register("scoped_opened_in_range")
def scoped_opened_in_range(spark, sf_dir):
    """One repository, a date range and a label group."""
    lc = metrics.scope(
        lifecycle_of(spark, sf_dir),
        repo=("ASIA", "NATION_2"),
        date_col="created_date",
        start="1997-01-01",
        end="1998-12-31",
        label_group="A",
    )
    return lc.groupBy(*metrics.REPO_KEYS, "label_group").agg(F.count(F.lit(1)).alias("issue_count"))


# --------------------------------------------------------------------------
# Silver operators on payloads and versions derived from the tables
# --------------------------------------------------------------------------

from tidemark.plans import quality  # noqa: E402
from tidemark.plans import silver as sv  # noqa: E402

# Merge scenario on events (cutoff and lookback of the delta).
MERGE_CUTOFF = dt.datetime(2024, 1, 20)
MERGE_LOOKBACK = dt.timedelta(days=5)

FLAT_COLUMNS = [
    "issue_id", "issue_node_id", "repo_owner", "repo_name", "issue_number", "title", "state", "state_reason",
    "is_locked", "created_at", "updated_at", "closed_at", "html_url", "api_url", "author_association",
    "comment_count", "is_pull_request", "author_login", "author_id", "author_type", "assignee_count",
    "pull_request_url", "source_run_id", "source_page_number",
]


def flattened(spark, sf_dir):
    return sv.flatten(tables.bronze_pages(spark, sf_dir), RUN_TS)


@register("flatten_payload")
def flatten_payload(spark, sf_dir):
    """Parse issue payload JSON once into typed columns (round trip)."""
    return flattened(spark, sf_dir).select(*FLAT_COLUMNS)


@register("explode_labels")
def explode_labels(spark, sf_dir):
    """Label rows exploded from the payload's label objects."""
    return sv.labels_of(flattened(spark, sf_dir), RUN_TS).drop("record_loaded_at")


@register("explode_assignees")
def explode_assignees(spark, sf_dir):
    """Assignee rows exploded from the payload's assignee objects."""
    return sv.assignees_of(flattened(spark, sf_dir), RUN_TS).drop("record_loaded_at")


@register("shape_issue")
def shape_issue(spark, sf_dir):
    """The shaped issue view (object-only arrays, non-empty name lists, PR flag)."""
    shaped = sv.shape_issues(tables.bronze_pages(spark, sf_dir), RUN_TS)
    return shaped.select(
        "issue_id", "repo_owner", "repo_name", "title", "state", "comment_count", "author_login",
        "is_pull_request", "label_names", "assignee_logins",
        F.size("labels").cast("bigint").alias("label_objects"),
        F.size("assignees").cast("bigint").alias("assignee_objects"),
    )


def _versions(spark, sf_dir):
    ev = tables.event_versions(spark, sf_dir)
    return ev.withColumn("source_payload_json", F.to_json(F.struct("event_id", "value", "props")))


def _as_batch(df, recorded_at, run_id):
    return df.select(
        "repo_owner", "repo_name", "issue_id", "updated_at", "event_id", "value", "props",
        F.lit(recorded_at).cast("timestamp").alias("source_recorded_at"),
        F.lit(run_id).alias("source_run_id"),
    )


_EVENT_ORDER = ["updated_at", "source_recorded_at", "source_run_id", "event_id"]


def _merge(frames):
    from functools import reduce

    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    order = [F.col(c).desc_nulls_last() for c in _EVENT_ORDER]
    return ops.latest_by_key(union, ISSUE_KEYS, order)


def _winner_columns(df):
    return df.select(*ISSUE_KEYS, "updated_at", "event_id", "value")


@register("snapshot_merge")
def snapshot_merge(spark, sf_dir):
    """I4: existing snapshot (latest before a cutoff) merged with a delta that
    re-delivers a lookback window; equals the latest version over all rows."""
    ev = _versions(spark, sf_dir)
    lo = MERGE_CUTOFF - MERGE_LOOKBACK
    existing = ops.latest_by_key(
        ev.filter(F.col("updated_at") < F.lit(MERGE_CUTOFF)), ISSUE_KEYS,
        [F.col("updated_at").desc_nulls_last(), F.col("event_id").desc()],
    )
    delta = ev.filter(F.col("updated_at") >= F.lit(lo))
    merged = _merge([_as_batch(existing, MERGE_CUTOFF, "r1"), _as_batch(delta, MERGE_CUTOFF + dt.timedelta(days=30), "r2")])
    return _winner_columns(merged)


@register("late_data_wins")
def late_data_wins(spark, sf_dir):
    """Deltas applied out of order; an older version arriving later never wins."""
    ev = _versions(spark, sf_dir)
    newer = ev.filter(F.col("updated_at") >= F.lit(MERGE_CUTOFF))
    older = ev.filter(F.col("updated_at") < F.lit(MERGE_CUTOFF))
    first = _merge([_as_batch(newer, MERGE_CUTOFF, "r1")])
    merged = _merge([first, _as_batch(older, MERGE_CUTOFF + dt.timedelta(days=30), "r2")])
    return _winner_columns(merged)


@register("schema_evolution")
def schema_evolution(spark, sf_dir):
    """A legacy snapshot (string times, no value column) merged by name
    with a typed delta; drifted types are try_cast, missing columns are NULL."""
    ev = _versions(spark, sf_dir)
    lo = MERGE_CUTOFF - MERGE_LOOKBACK
    existing = ops.latest_by_key(
        ev.filter(F.col("updated_at") < F.lit(MERGE_CUTOFF)), ISSUE_KEYS,
        [F.col("updated_at").desc_nulls_last(), F.col("event_id").desc()],
    )
    legacy = _as_batch(existing, MERGE_CUTOFF, "r1").drop("value").withColumn(
        "updated_at", F.col("updated_at").cast("string")
    )
    delta = _as_batch(ev.filter(F.col("updated_at") >= F.lit(lo)), MERGE_CUTOFF + dt.timedelta(days=30), "r2")
    union = ops.union_by_declared_schema([legacy, delta], delta.schema)
    order = [F.col(c).desc_nulls_last() for c in _EVENT_ORDER]
    return _winner_columns(ops.latest_by_key(union, ISSUE_KEYS, order))


def derived_manifests(spark, sf_dir, issues=None):
    bronze = tables.bronze_index(spark, sf_dir, issues)
    totals = sv.run_totals(bronze)
    fin = bronze.groupBy("repo_owner", "repo_name", "run_id").agg(F.max("fetched_at").alias("finished_at"))
    return totals.join(fin, ["repo_owner", "repo_name", "run_id"]).withColumn("status", F.lit("success"))


@register("run_totals")
def run_totals(spark, sf_dir):
    """Pages, records and max updated_at per landed run."""
    return sv.run_totals(tables.bronze_index(spark, sf_dir))


@register("latest_runs")
def latest_runs(spark, sf_dir):
    """Latest successful run per repository."""
    return sv.latest_manifests(derived_manifests(spark, sf_dir)).select(
        "repo_owner", "repo_name", "run_id", "finished_at", "pages_fetched", "records_fetched"
    )


# Columns of the snapshot that the silver checks read.
QUALITY_ISSUE_COLUMNS = [*ISSUE_KEYS, "created_at", "closed_at", "updated_at", "is_pull_request"]


def materialize(spark, df):
    """Cut lineage: write ``df`` once as a Parquet table in the shared
    checkpoint folder (``spark.checkpoint.dir``) and read it back, for inputs
    that several checks consume. One computation, columnar and prunable on
    read (an RDD checkpoint would compute its input twice)."""
    from tidemark.session import checkpoint_dir

    location = f"{checkpoint_dir(spark).rstrip('/')}/materialized-{uuid.uuid4().hex}"
    df.write.parquet(location)
    return spark.read.schema(df.schema).parquet(location)


def _sync(spark, sf_dir, raw_close=False, issues=None, manifests=None):
    issues = issues if issues is not None else tables.issues(spark, sf_dir, raw_close)
    manifests = manifests if manifests is not None else derived_manifests(spark, sf_dir, issues)
    return sv.sync_rows(issues, manifests, "v1", RUN_TS)


@register("sync_state")
def sync_state(spark, sf_dir):
    """Per-repository high-water mark and last merged run."""
    return _sync(spark, sf_dir).drop("version", "committed_at")


@register("watermark_lookback")
def watermark_lookback(spark, sf_dir):
    """since = watermark - 30 days."""
    return sv.watermark_since(_sync(spark, sf_dir))


@register("dq_silver")
def dq_silver(spark, sf_dir):
    """D1-D6 report; closing times taken raw so that D3 finds violations."""
    issues = materialize(spark, tables.issues(spark, sf_dir, raw_close=True).select(*QUALITY_ISSUE_COLUMNS))
    # run ids and finish times depend on creation days only, so the manifests
    # come from the same materialized rows
    manifests = derived_manifests(spark, sf_dir, issues)
    return quality.silver_report(
        issues,
        tables.issue_labels(spark, sf_dir),
        tables.issue_assignees(spark, sf_dir),
        _sync(spark, sf_dir, issues=issues, manifests=manifests),
        manifests,
    )


@register("dq_gold")
def dq_gold(spark, sf_dir):
    """D7-D9 report over the lifecycle and daily-flow marts."""
    issues = tables.issues(spark, sf_dir)
    lc = marts.lifecycle(issues, tables.issue_labels(spark, sf_dir), tables.issue_assignees(spark, sf_dir), RUN_TS)
    # only what the gold checks read: keys, PR flag, event days
    lc = materialize(spark, lc.select(*ISSUE_KEYS, "created_date", "closed_date", "is_closed"))
    flags = materialize(spark, issues.select(*ISSUE_KEYS, "is_pull_request"))
    return quality.gold_report(lc, marts.daily_flow(lc), flags)


# --------------------------------------------------------------------------
# Streaming variants (I10, I11): run to completion over what is available
# --------------------------------------------------------------------------

from tidemark.streaming import incremental  # noqa: E402


def _event_stream(spark, sf_dir):
    """The events table as a file stream (the folder, filtered to its file)."""
    schema = tables.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@register("stream_daily_event_counts")
def stream_daily_event_counts(spark, sf_dir):
    """Events per type and UTC day from an event-time windowed stream."""
    stream = _event_stream(spark, sf_dir).select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    return incremental.run_daily_counts(spark, stream, ["event_type"], "ts")


@register("stream_snapshot_merge")
def stream_snapshot_merge(spark, sf_dir):
    """Micro-batch upsert of event versions into a committed snapshot."""
    stream = _event_stream(spark, sf_dir).select(
        F.lit("events").alias("repo_owner"),
        F.col("event_type").alias("repo_name"),
        F.col("user_id").alias("issue_id"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        "event_id",
        "value",
    )
    sink = incremental.SnapshotSink(incremental.scratch(spark, "snapshot"), ISSUE_KEYS, ["updated_at", "event_id"])
    q = incremental.upsert_stream(stream, sink, incremental.scratch(spark, "snapshot-ckpt"))
    q.awaitTermination()
    return sink.current(spark)


@register("rolling_7d")
def rolling_7d(spark, sf_dir):
    """The 7-day rolling sums of the dense daily flow."""
    flow = marts.daily_flow(lifecycle_of(spark, sf_dir))
    return flow.select("repo_owner", "repo_name", "calendar_date", "rolling_7d_opened", "rolling_7d_closed", "rolling_7d_net_change")


@register("recently_updated")
def recently_updated(spark, sf_dir):
    """L3: ten most recently updated shaped rows per repository (PRs included)."""
    return metrics.recently_updated(sv.shape_issues(tables.bronze_pages(spark, sf_dir), RUN_TS))


from tidemark.plans import lake_queries  # noqa: E402, F401
