"""Data quality gates (D1-D9) as one report per layer.

Each check yields ``(repo_owner, repo_name, violations)``; all checks are
unioned into one report with a row for every (check, repository), so a clean
repository shows 0. One action (``assert_clean``) decides pass or fail.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.plans.silver import latest_manifests
from tidemark.schemas import ISSUE_KEYS, REPO_KEYS

# Check ids and messages.
SILVER_CHECKS = {
    "D1": "Null issue_id in silver",
    "D2": "Duplicate issue_id rows in silver current snapshot",
    "D3": "closed_at before created_at (>1h tolerance)",
    "D4": "Orphan label rows in silver",
    "D5": "Orphan assignee rows in silver",
    "D6": "Sync state mismatch with latest successful manifest",
}
GOLD_CHECKS = {
    "D7": "PR contamination in gold mart_issue_lifecycle",
    "D8": "Gold lifecycle count mismatch versus silver non-PR issues",
    "D9": "Gaps detected in gold mart_issue_daily_flow date spine",
}


class QualityError(AssertionError):
    pass


def _per_repo(df: DataFrame) -> DataFrame:
    return df.groupBy(*REPO_KEYS).agg(F.count(F.lit(1)).alias("violations"))


def issue_facts(issues: DataFrame, tolerance: str = "1 HOUR") -> DataFrame:
    """One aggregation pass over the snapshot for the per-repository checks:
    D1 null ids, D3 closed-before-created, the D6 watermark and the D8 count."""
    early = F.col("closed_at").isNotNull() & (F.col("closed_at") < F.col("created_at") - F.expr(f"INTERVAL {tolerance}"))
    return issues.groupBy(*REPO_KEYS).agg(
        F.count_if(F.col("issue_id").isNull()).cast("bigint").alias("null_ids"),
        F.count_if(early).cast("bigint").alias("closed_early"),
        F.max("updated_at").alias("s_max"),
        F.count_if(F.col("is_pull_request") == F.lit(False)).cast("bigint").alias("non_pr"),
    )


def null_ids(issues: DataFrame) -> DataFrame:
    return _per_repo(issues.filter(F.col("issue_id").isNull()))


def duplicate_ids(issues: DataFrame) -> DataFrame:
    return _per_repo(ops.duplicate_key_groups(issues.filter(F.col("issue_id").isNotNull()), ISSUE_KEYS))


def closed_before_created(issues: DataFrame, tolerance: str = "1 HOUR") -> DataFrame:
    bad = F.col("closed_at").isNotNull() & (F.col("closed_at") < F.col("created_at") - F.expr(f"INTERVAL {tolerance}"))
    return _per_repo(issues.filter(bad))


def orphans(child: DataFrame, issues: DataFrame) -> DataFrame:
    return _per_repo(ops.orphan_rows(child, issues, ISSUE_KEYS))


def sync_mismatch(
    issues: DataFrame, sync_state: DataFrame | None, manifests: DataFrame, marks: DataFrame | None = None
) -> DataFrame:
    """D6 per repository: state must name the latest successful run, its finish
    time and the snapshot's max updated_at (NULL-safe). A repository with issues
    or manifests but no state row is a violation too."""
    latest = latest_manifests(manifests).select(*REPO_KEYS, F.col("run_id").alias("m_run"), F.col("finished_at").alias("m_fin"))
    if marks is None:
        marks = issues.groupBy(*REPO_KEYS).agg(F.max("updated_at").alias("s_max"))
    marks = marks.select(*REPO_KEYS, "s_max")
    repos = latest.select(*REPO_KEYS).unionByName(marks.select(*REPO_KEYS))
    if sync_state is not None:
        repos = repos.unionByName(sync_state.select(*REPO_KEYS))
    base = repos.distinct().join(latest, list(REPO_KEYS), "left").join(marks, list(REPO_KEYS), "left")
    if sync_state is None:
        return base.select(*REPO_KEYS, F.lit(1).cast("bigint").alias("violations"))
    st = sync_state.select(
        *REPO_KEYS,
        F.lit(True).alias("has_state"),
        "last_successful_bronze_run_id",
        "last_successful_run_finished_at",
        "last_successful_watermark_updated_at",
    )
    j = base.join(st, list(REPO_KEYS), "left")
    bad = (
        F.col("has_state").isNull()
        | ~F.col("last_successful_bronze_run_id").eqNullSafe(F.col("m_run"))
        | ~F.col("last_successful_run_finished_at").eqNullSafe(F.col("m_fin"))
        | ~F.col("last_successful_watermark_updated_at").eqNullSafe(F.col("s_max"))
    )
    return j.select(*REPO_KEYS, F.when(bad, 1).otherwise(0).cast("bigint").alias("violations"))


def pr_contamination(lifecycle: DataFrame, issues: DataFrame) -> DataFrame:
    prs = issues.filter(F.col("is_pull_request") == F.lit(True)).select(*ISSUE_KEYS)
    return _per_repo(lifecycle.select(*ISSUE_KEYS).join(prs, ISSUE_KEYS, "left_semi"))


def lifecycle_count_gap(lifecycle: DataFrame, issues: DataFrame) -> DataFrame:
    g = lifecycle.groupBy(*REPO_KEYS).agg(F.count(F.lit(1)).alias("g"))
    s = issues.filter(F.col("is_pull_request") == F.lit(False)).groupBy(*REPO_KEYS).agg(F.count(F.lit(1)).alias("s"))
    j = g.join(s, list(REPO_KEYS), "full")
    return j.select(*REPO_KEYS, F.abs(F.coalesce("g", F.lit(0)) - F.coalesce("s", F.lit(0))).cast("bigint").alias("violations"))


def spine_gaps(flow: DataFrame) -> DataFrame:
    return _per_repo(ops.spine_gap_groups(flow, REPO_KEYS, "calendar_date"))


def report(results: dict[str, DataFrame], messages: dict[str, str], repos: DataFrame) -> DataFrame:
    """Every (check, repository) with its violation count (0 when clean)."""
    found = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(cid).alias("check_id"), *REPO_KEYS, "violations") for cid, df in results.items()],
    )
    found = found.groupBy("check_id", *REPO_KEYS).agg(F.sum("violations").alias("violations"))
    names = F.create_map(*[x for cid, msg in messages.items() for x in (F.lit(cid), F.lit(msg))])
    grid = repos.select(*REPO_KEYS).distinct().select(*REPO_KEYS, F.explode(F.array(*[F.lit(c) for c in results])).alias("check_id"))
    out = grid.join(found, ["check_id", *REPO_KEYS], "left")
    return out.select(
        "check_id",
        names[F.col("check_id")].alias("check_name"),
        *REPO_KEYS,
        F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"),
    )


def silver_report(issues, labels, assignees, sync_state, manifests) -> DataFrame:
    facts = issue_facts(issues)
    repos = facts.select(*REPO_KEYS).unionByName(manifests.select(*REPO_KEYS))
    results = {
        "D1": facts.select(*REPO_KEYS, F.col("null_ids").alias("violations")),
        "D2": duplicate_ids(issues),
        "D3": facts.select(*REPO_KEYS, F.col("closed_early").alias("violations")),
        "D4": orphans(labels, issues),
        "D5": orphans(assignees, issues),
        "D6": sync_mismatch(issues, sync_state, manifests, facts),
    }
    return report(results, SILVER_CHECKS, repos)


def gold_report(lifecycle, flow, issues) -> DataFrame:
    repos = issues.select(*REPO_KEYS).unionByName(lifecycle.select(*REPO_KEYS)).distinct()
    results = {
        "D7": pr_contamination(lifecycle, issues),
        "D8": lifecycle_count_gap(lifecycle, issues),
        "D9": spine_gaps(flow),
    }
    return report(results, GOLD_CHECKS, repos)


def assert_clean(report_df: DataFrame, sample: int = 20) -> None:
    """Raise naming the failing checks, expected 0 and the actual counts."""
    bad = report_df.filter(F.col("violations") != 0)
    rows = bad.orderBy("check_id", *REPO_KEYS).limit(sample).collect()
    if rows:
        total = bad.agg(F.count("*").alias("pairs"), F.sum("violations").alias("violations")).first()
        lines = [
            f"{r.check_id} {r.check_name} [{r.repo_owner}/{r.repo_name}]: expected 0, got {r.violations}"
            for r in rows
        ]
        raise QualityError(
            f"Data quality checks failed: {total.pairs} checks of repositories, {total.violations} violations"
            + (f"; the first {sample}:" if total.pairs > sample else ":") + "\n" + "\n".join(lines)
        )
