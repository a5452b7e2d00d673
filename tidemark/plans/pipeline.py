"""Pipeline entry points (E1-E6): land -> silver -> checks -> gold -> checks.

Each stage reads what the previous stage *persisted*, so a stage can run in a
separate process (or be retried after an executor or driver loss) and the
quality gates test the stored tables, not in-memory plans. Writes go to new
version directories; commit rows come last, so a failed stage changes nothing
visible and a retried one is idempotent.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans import marts, quality, silver
from tidemark.schemas import REPO_KEYS
from tidemark.session import configure
from tidemark.sources import landing
from tidemark.sources.storage import Lake, append, commit, next_sequence, write_version


def _version(sequence: int, run_ts: dt.datetime) -> str:
    """A version's name: versions are ordered by sequence, not by the caller's clock."""
    return f"{sequence:012d}-{run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def _repo_filter(df: DataFrame, repos: list[tuple[str, str]] | None) -> DataFrame:
    if not repos:
        return df
    cond = None
    for owner, name in repos:
        c = (F.col("repo_owner") == owner) & (F.col("repo_name") == name)
        cond = c if cond is None else cond | c
    return df.filter(cond)


# E1 -------------------------------------------------------------------------


def land(
    spark: SparkSession,
    pages_dir: str,
    base: str,
    finished_at: dt.datetime,
    since: dt.datetime | DataFrame | None = None,
) -> DataFrame:
    """Land the page files under ``pages_dir`` of runs not landed yet; then commit one manifest row per run.

    Records updated before ``since`` are left out: a time for every repository (a backfill's override), or a
    row (repo keys, since) for each, as ``read_watermarks`` gives; without it everything is landed.

    Pages are written first, the manifest last (I8): if the write fails, no
    manifest exists and silver never sees the run (I3). A run has a folder of its
    own that is replaced, so a landing repeated after a failure leaves no page
    twice; a run with a manifest is left alone.
    """
    configure(spark)
    lake = Lake(spark, base)
    landed = lake.read_manifests().select(*REPO_KEYS, "run_id")
    pages = landing.read_page_files(spark, pages_dir).join(landed, [*REPO_KEYS, "run_id"], "left_anti")
    pages = landing.apply_since(pages, since)
    landing.bronze_rows(pages).hint("rebalance", "repo_owner", "repo_name", "run_id").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("repo_owner", "repo_name", "run_id").parquet(lake.bronze)
    append(landing.manifests_for(pages, finished_at), lake.manifests)
    return lake.read_manifests()


def manifest_history(spark: SparkSession, base: str) -> DataFrame:
    """Every landed run, oldest first (ties by run id)."""
    return Lake(spark, base).read_manifests().orderBy(*REPO_KEYS, "finished_at", "run_id")


def latest_runs(spark: SparkSession, base: str) -> DataFrame:
    """E5: latest successful run per repository."""
    return silver.latest_manifests(Lake(spark, base).read_manifests())


def read_watermarks(spark: SparkSession, base: str, lookback_days: int = 30) -> DataFrame | None:
    """``since`` per repository; ``None`` when nothing was ever synced.

    A missing state is normal (first run); an unreadable one raises, so a
    broken state never silently triggers a full reload.
    """
    state = Lake(spark, base).sync_state()
    if state is None:
        return None
    return silver.watermark_since(state, lookback_days)


# E2 -------------------------------------------------------------------------


class NoSuccessfulRun(RuntimeError):
    """A repository is asked for that no run has been landed for."""


def _require_runs(manifests: DataFrame, repos: list[tuple[str, str]] | None) -> None:
    """A lake, or one of ``repos``, without a successful run is an error and not an empty snapshot."""
    ok = _repo_filter(manifests.filter(F.col("status") == "success"), repos).select(*REPO_KEYS).distinct()
    if not repos:
        if ok.isEmpty():
            raise NoSuccessfulRun("no successful run has been landed")
        return
    have = {(r.repo_owner, r.repo_name) for r in ok.collect()}  # at most the repositories asked for
    missing = sorted(set(repos) - have)
    if missing:
        raise NoSuccessfulRun("no successful run has been landed for " + ", ".join(f"{o}/{n}" for o, n in missing))


def build_silver(
    spark: SparkSession,
    base: str,
    run_ts: dt.datetime,
    repos: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Merge every successful, not yet merged run into the current snapshot.

    Returns the committed sync-state rows of this run: none, and nothing written, if no run is new.
    """
    configure(spark)
    lake = Lake(spark, base)
    manifests = lake.read_manifests()
    _require_runs(manifests, repos)
    runs = _repo_filter(silver.runs_to_merge(manifests, lake.merged_runs()), repos)
    if runs.isEmpty():
        return lake.sync_state().limit(0)
    return merge_runs(spark, base, runs, run_ts)


def merge_runs(spark: SparkSession, base: str, runs: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Merge the pages of ``runs`` (repo keys, run_id, finished_at) into
    the committed snapshot of their repositories, rebuild the children, then
    commit one sync-state row per repository (the commit point)."""
    configure(spark)
    lake = Lake(spark, base)
    sequence = next_sequence(spark, lake.sync_log, schemas.SYNC_LOG)
    version = _version(sequence, run_ts)
    run_keys = runs.select(*REPO_KEYS, "run_id")
    # The run list is tiny (one row per run); the semi-join prunes bronze to
    # the selected run_id partitions, whatever types their files have.
    delta_raw = lake.read_bronze(run_keys)
    delta = silver.flatten(delta_raw, run_ts)
    touched = runs.select(*REPO_KEYS).distinct()
    existing = lake.silver("issue_current").join(touched, list(REPO_KEYS), "left_semi")
    merged = silver.merge_current(existing, delta, run_ts)
    # Write the snapshot once, then derive everything else from the written
    # version (computed once, lineage cut at the write).
    write_version(merged, lake.silver_table("issue_current"), version)
    written = _read_version(spark, lake.silver_table("issue_current"), "ISSUE_CURRENT", version)
    write_version(silver.labels_of(written, run_ts), lake.silver_table("issue_labels"), version)
    write_version(silver.assignees_of(written, run_ts), lake.silver_table("issue_assignees"), version)

    # the state names the newest of all merged runs, also when an older run arrives late
    fresh = runs.select(*REPO_KEYS, "run_id", "finished_at")
    before = lake.merged_runs()
    every = fresh if before is None else fresh.unionByName(
        before.select(*fresh.columns).join(touched, list(REPO_KEYS), "left_semi"))
    commits = silver.sync_rows(written, every, version, run_ts)
    # the run list counts only with its version's commit row, which comes last
    append(fresh.withColumn("version", F.lit(version)), lake.merged_log)
    commit(commits, lake.sync_log, schemas.SYNC_LOG, sequence)
    # the selection of ``runs`` now finds nothing: return what is stored
    return lake.sync_state().filter(F.col("version") == version)


def _read_version(spark: SparkSession, location: str, schema_name: str, version: str) -> DataFrame:
    """The rows just written as ``version`` (typed empty when it wrote no rows)."""
    return _glob_read(spark, location, schema_name, version)


def _glob_read(spark: SparkSession, location: str, schema_name: str, version: str) -> DataFrame:
    from pyspark.errors import AnalysisException

    from tidemark.sources.storage import is_missing_path

    try:
        df = (
            spark.read.schema(storage_schema(schema_name))
            .option("basePath", location)
            .parquet(f"{location.rstrip('/')}/repo_owner=*/repo_name=*/version={version}")
        )
    except AnalysisException as exc:
        if is_missing_path(exc):
            return spark.createDataFrame([], schemas.schema_of(schema_name))
        raise
    return df.drop("version")


def import_snapshot(spark: SparkSession, base: str, legacy_path: str, run_ts: dt.datetime) -> DataFrame:
    """Adopt a snapshot written by an older layout or schema.

    The legacy files are read with their own schema (string times, missing
    ``source_*`` columns), conformed by name to the declared schema with
    ``try_cast``, merged with whatever is committed for those repositories and
    committed as a new version. Later runs then merge onto typed data.
    """
    configure(spark)
    lake = Lake(spark, base)
    sequence = next_sequence(spark, lake.sync_log, schemas.SYNC_LOG)
    version = _version(sequence, run_ts)
    legacy = spark.read.parquet(legacy_path)
    touched = legacy.select(*REPO_KEYS).distinct()
    existing = lake.silver("issue_current").join(touched, list(REPO_KEYS), "left_semi")
    merged = silver.merge_current(existing, legacy, run_ts)
    write_version(merged, lake.silver_table("issue_current"), version)
    written = _read_version(spark, lake.silver_table("issue_current"), "ISSUE_CURRENT", version)
    write_version(silver.labels_of(written, run_ts), lake.silver_table("issue_labels"), version)
    write_version(silver.assignees_of(written, run_ts), lake.silver_table("issue_assignees"), version)
    state = lake.sync_state()
    prior = (
        state.select(*REPO_KEYS, F.col("last_successful_bronze_run_id").alias("run_id"),
                     F.col("last_successful_run_finished_at").alias("finished_at"))
        if state is not None
        else spark.createDataFrame([], "repo_owner string, repo_name string, run_id string, finished_at timestamp")
    )
    runs = touched.join(prior, list(REPO_KEYS), "left")
    commit(silver.sync_rows(written, runs, version, run_ts), lake.sync_log, schemas.SYNC_LOG, sequence)
    return lake.sync_state().filter(F.col("version") == version)


def storage_schema(name: str):
    from tidemark.sources.storage import with_partitions

    return with_partitions(schemas.schema_of(name), "version")


# E3 -------------------------------------------------------------------------


def build_gold(
    spark: SparkSession,
    base: str,
    run_ts: dt.datetime,
    repos: list[tuple[str, str]] | None = None,
    everything: bool = False,
) -> None:
    """Rebuild the five marts of each repository whose committed silver version they are not of.

    Repositories without a new version keep theirs; ``everything`` rebuilds them all (after a change of the marts).

    The lifecycle mart is written first and read back narrow; the other marts
    fan out from the stored copy, so the label / assignee joins run once.
    """
    configure(spark)
    lake = Lake(spark, base)
    sequence = next_sequence(spark, lake.gold_log, schemas.GOLD_LOG)
    version = _version(sequence, run_ts)
    state = lake.sync_state()
    if state is None:
        return
    built = lake.gold_commits()
    if built is not None and not everything:
        done = built.select(*REPO_KEYS, F.col("silver_version").alias("version"))
        state = state.join(done, [*REPO_KEYS, "version"], "left_anti")
    state = lake.pinned(_repo_filter(state, repos))
    if state.isEmpty():
        return
    issues = lake.silver("issue_current", state)
    lc = marts.lifecycle(issues, lake.silver("issue_labels", state), lake.silver("issue_assignees", state), run_ts)
    write_version(lc, lake.gold_table("mart_issue_lifecycle"), version, ["created_date", "issue_id"])
    stored = _read_version(spark, lake.gold_table("mart_issue_lifecycle"), "MART_LIFECYCLE", version)
    flow = marts.daily_flow(stored)
    write_version(flow, lake.gold_table("mart_issue_daily_flow"), version, ["calendar_date"])
    stored_flow = _read_version(spark, lake.gold_table("mart_issue_daily_flow"), "MART_DAILY_FLOW", version)
    write_version(marts.closure_age_monthly(stored), lake.gold_table("mart_issue_closure_age_monthly"), version, ["year_month"])
    write_version(marts.weekday_rhythm(stored), lake.gold_table("mart_issue_weekday_rhythm"), version, ["event_type", "weekday_num"])
    write_version(marts.swing_days(stored_flow), lake.gold_table("mart_issue_swing_days"), version, ["calendar_date"])
    commits = state.select(*REPO_KEYS, F.lit(version).alias("version"), F.lit(run_ts).cast("timestamp").alias("committed_at"),
                           F.col("version").alias("silver_version"))
    commit(commits, lake.gold_log, schemas.GOLD_LOG, sequence)


# E4 -------------------------------------------------------------------------


def check_report(spark: SparkSession, base: str, mode: str) -> DataFrame:
    """The quality report of the persisted tables for ``mode`` silver or gold."""
    configure(spark)
    lake = Lake(spark, base)
    state = lake.pinned_state()
    issues = lake.silver("issue_current", state)
    if mode == "silver":
        return quality.silver_report(
            issues,
            lake.silver("issue_labels", state),
            lake.silver("issue_assignees", state),
            state,
            lake.read_manifests(),
        )
    if mode == "gold":
        commits = lake.pinned(lake.gold_commits())
        return quality.gold_report(lake.gold("mart_issue_lifecycle", commits), lake.gold("mart_issue_daily_flow", commits), issues)
    raise ValueError(f"Unknown mode: {mode!r}. Use 'silver' or 'gold'.")


def run_checks(spark: SparkSession, base: str, mode: str) -> None:
    quality.assert_clean(check_report(spark, base, mode))


# E6 -------------------------------------------------------------------------


def run_all(
    spark: SparkSession,
    pages_dir: str,
    base: str,
    run_ts: dt.datetime,
    since: dt.datetime | None = None,
) -> None:
    """Stage order: bronze -> silver -> silver checks -> gold -> gold checks.

    Landing starts from each repository's watermark; ``since`` overrides it for all of them.
    """
    land(spark, pages_dir, base, run_ts, read_watermarks(spark, base) if since is None else since)
    build_silver(spark, base, run_ts)
    run_checks(spark, base, "silver")
    build_gold(spark, base, run_ts)
    run_checks(spark, base, "gold")
