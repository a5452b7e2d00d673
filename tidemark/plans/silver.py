"""Silver layer: flatten issue payloads, merge deltas into the current snapshot,
rebuild the label / assignee child tables and derive the sync state.

Everything is a lazy DataFrame transformation; ``tidemark.plans.pipeline``
decides what is written and when.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark import operators as ops
from tidemark import schemas
from tidemark.schemas import ISSUE_KEYS, REPO_KEYS

ENDPOINT = "issues"


def _ts(run_ts) -> Column:
    return F.lit(run_ts).cast("timestamp")


# --------------------------------------------------------------------------
# flatten
# --------------------------------------------------------------------------


def flatten(bronze: DataFrame, run_ts) -> DataFrame:
    """Bronze rows -> typed ``issue_current`` columns.

    The payload is parsed ONCE into a declared struct; each column is then a
    field access. A malformed field becomes NULL (``try_cast``) and the rest of
    the row survives. Rows without an issue id are dropped (P2).
    """
    p = F.from_json("payload_json", schemas.ISSUE_PAYLOAD)
    parsed = bronze.filter(F.col("issue_id").isNotNull()).withColumn("_p", p)
    f = lambda path: F.col(f"_p.{path}")
    return parsed.select(
        F.col("issue_id").cast("bigint").alias("issue_id"),
        f("node_id").alias("issue_node_id"),
        "repo_owner",
        "repo_name",
        tf.try_long(f("number")).alias("issue_number"),
        f("title").alias("title"),
        f("state").alias("state"),
        f("state_reason").alias("state_reason"),
        tf.try_bool(f("locked")).alias("is_locked"),
        f("active_lock_reason").alias("active_lock_reason"),
        tf.try_timestamp(f("created_at")).alias("created_at"),
        tf.try_timestamp(f("updated_at")).alias("updated_at"),
        tf.try_timestamp(f("closed_at")).alias("closed_at"),
        f("html_url").alias("html_url"),
        f("url").alias("api_url"),
        f("comments_url").alias("comments_url"),
        f("events_url").alias("events_url"),
        f("author_association").alias("author_association"),
        tf.try_long(f("comments")).alias("comment_count"),
        tf.json_key_present("payload_json", "pull_request").alias("is_pull_request"),
        f("user.login").alias("author_login"),
        tf.try_long(f("user.id")).alias("author_id"),
        f("user.type").alias("author_type"),
        F.coalesce(F.json_array_length(f("assignees")), F.lit(0)).cast("bigint").alias("assignee_count"),
        f("milestone.title").alias("milestone_title"),
        f("closed_by.login").alias("closed_by_login"),
        f("performed_via_github_app.name").alias("performed_via_github_app_name"),
        f("pull_request.url").alias("pull_request_url"),
        f("pull_request.html_url").alias("pull_request_html_url"),
        f("body").alias("body"),
        _ts(run_ts).alias("record_loaded_at"),
        F.col("run_id").alias("source_run_id"),
        F.col("fetched_at").alias("source_recorded_at"),
        F.col("page_number").cast("int").alias("source_page_number"),
        F.col("payload_json").alias("source_payload_json"),
    )


# --------------------------------------------------------------------------
# U1 + W1: merge
# --------------------------------------------------------------------------

# Winner order: newest update, then latest fetch, run, page, payload text; NULLs last.
MERGE_KEYS = ["updated_at", "source_recorded_at", "source_run_id", "source_page_number", "source_payload_json"]


def merge_order() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in MERGE_KEYS]


def merge_current(existing: DataFrame | None, delta: DataFrame, run_ts) -> DataFrame:
    """Union the prior snapshot and the delta by name, keep the latest per issue.

    Both sides are conformed to the declared schema first (missing columns as
    NULL, drifted types via ``try_cast``). Issues absent from the delta carry
    forward; an older version never replaces a newer one. Re-applying a delta
    is a no-op, so a retried run is harmless. The whole union is ranked at every
    size, so the rows never depend on how large the delta is.
    """
    cand = ops.conform(delta, schemas.ISSUE_CURRENT)
    if existing is not None:
        cand = ops.conform(existing, schemas.ISSUE_CURRENT).unionByName(cand)
    return ops.latest_by_key(cand, ISSUE_KEYS, merge_order()).withColumn("record_loaded_at", _ts(run_ts))


# --------------------------------------------------------------------------
# children
# --------------------------------------------------------------------------


def _distinct_elements(current: DataFrame, field: str, schema, typed, flag: str) -> DataFrame:
    """The different elements of each issue's array that have ``flag``, typed, as ``_e``.

    Each element is parsed once, on its own, so that an odd one spoils no other; ``typed`` takes fields of the parsed
    element. The snapshot has one row per issue, so duplicates lie within one array and need no shuffle.
    """
    arr = F.from_json(F.get_json_object("source_payload_json", f"$.{field}"), "array<string>")
    parsed = F.transform(arr, lambda el: F.from_json(el, schema))
    kept = F.filter(F.transform(parsed, typed), lambda e: e[flag])
    return current.select(*ISSUE_KEYS, F.explode(F.array_distinct(kept)).alias("_e"))


def labels_of(current: DataFrame, run_ts) -> DataFrame:
    """Label rows rebuilt from the whole snapshot (a removed label disappears).

    Rows need an ``id`` text; a non-numeric id keeps the row with NULL label_id.
    """
    def typed(parsed: Column) -> Column:
        return F.struct(
            parsed["id"].isNotNull().alias("has_id"),
            tf.try_long(parsed["id"]).alias("label_id"),
            parsed["name"].alias("label_name"),
            parsed["description"].alias("label_description"),
            parsed["color"].alias("label_color"),
            tf.try_bool(parsed["default"]).alias("label_is_default"),
        )

    rows = _distinct_elements(current, "labels", schemas.LABEL_ELEMENT, typed, "has_id")
    return rows.select(*ISSUE_KEYS, "_e.*").drop("has_id").withColumn("record_loaded_at", _ts(run_ts))


def assignees_of(current: DataFrame, run_ts) -> DataFrame:
    """Assignee rows rebuilt from the whole snapshot; rows need a login."""
    def typed(parsed: Column) -> Column:
        return F.struct(
            parsed["login"].isNotNull().alias("has_login"),
            parsed["login"].alias("assignee_login"),
            tf.try_long(parsed["id"]).alias("assignee_id"),
            parsed["type"].alias("assignee_type"),
        )

    rows = _distinct_elements(current, "assignees", schemas.ASSIGNEE_ELEMENT, typed, "has_login")
    return rows.select(*ISSUE_KEYS, "_e.*").drop("has_login").withColumn("record_loaded_at", _ts(run_ts))


# --------------------------------------------------------------------------
# Run selection and sync state
# --------------------------------------------------------------------------


def latest_manifests(manifests: DataFrame) -> DataFrame:
    """Latest successful manifest per repository, by (finished_at, run_id)."""
    ok = manifests.filter(F.col("status") == "success")
    return ops.latest_by_key(ok, REPO_KEYS, [F.col("finished_at").desc_nulls_last(), F.col("run_id").desc_nulls_last()])


def runs_to_merge(manifests: DataFrame, merged: DataFrame | None) -> DataFrame:
    """I3 + Q2: successful runs that no committed version contains, whatever their finish time.

    Runs without a manifest row never appear, so a failed landing stays invisible;
    a run whose manifest arrives late, or with an equal finish time, is still merged.
    """
    ok = manifests.filter(F.col("status") == "success").groupBy(*REPO_KEYS, "run_id").agg(
        F.max("finished_at").alias("finished_at"))
    if merged is None:
        return ok
    return ok.join(merged.select(*REPO_KEYS, "run_id"), [*REPO_KEYS, "run_id"], "left_anti")


def sync_rows(current: DataFrame, merged_runs: DataFrame, version: str, run_ts) -> DataFrame:
    """One state row per repository: max updated_at (NULL when no issues)
    and the newest merged run, keyed from the run list so empty repositories
    still get a row."""
    newest = ops.latest_by_key(
        merged_runs, REPO_KEYS, [F.col("finished_at").desc_nulls_last(), F.col("run_id").desc_nulls_last()]
    )
    marks = current.groupBy(*REPO_KEYS).agg(F.max("updated_at").alias("last_successful_watermark_updated_at"))
    return newest.join(marks, list(REPO_KEYS), "left").select(
        *REPO_KEYS,
        F.lit(ENDPOINT).alias("endpoint_name"),
        "last_successful_watermark_updated_at",
        F.col("finished_at").alias("last_successful_run_finished_at"),
        F.col("run_id").alias("last_successful_bronze_run_id"),
        F.lit(version).alias("version"),
        _ts(run_ts).alias("committed_at"),
    )


def watermark_since(sync_state: DataFrame, lookback_days: int = 30) -> DataFrame:
    """``since = watermark - lookback``; NULL when never synced (full reload)."""
    return sync_state.select(
        *REPO_KEYS,
        "last_successful_watermark_updated_at",
        (F.col("last_successful_watermark_updated_at") - F.expr(f"INTERVAL {int(lookback_days)} DAYS")).alias("since"),
    )


def run_totals(bronze: DataFrame) -> DataFrame:
    """Pages, records and max updated_at per landed run."""
    return bronze.groupBy(*REPO_KEYS, "run_id").agg(
        F.countDistinct("page_number").alias("pages_fetched"),
        F.count(F.lit(1)).alias("records_fetched"),
        F.max("issue_updated_at").alias("max_issue_updated_at"),
    )


# --------------------------------------------------------------------------
# The demo's issue shaper, as column expressions
# --------------------------------------------------------------------------


def shape_issues(bronze: DataFrame, extracted_at: dt.datetime | str) -> DataFrame:
    """Keep the fields that answer the backlog question.

    Labels / assignees keep only object elements as structs; name lists keep
    only non-empty names; the pull-request flag is a non-empty object.
    """
    p = F.from_json("payload_json", schemas.ISSUE_PAYLOAD)
    lab = F.from_json(F.get_json_object("payload_json", "$.labels"), "array<string>")
    asg = F.from_json(F.get_json_object("payload_json", "$.assignees"), "array<string>")
    is_obj = lambda e: F.startswith(F.ltrim(e), F.lit("{"))
    lab_structs = F.transform(
        F.filter(F.coalesce(lab, F.array().cast("array<string>")), is_obj),
        lambda e: F.from_json(e, schemas.LABEL_ELEMENT),
    )
    asg_structs = F.transform(
        F.filter(F.coalesce(asg, F.array().cast("array<string>")), is_obj),
        lambda e: F.from_json(e, schemas.ASSIGNEE_ELEMENT),
    )
    pr_text = F.get_json_object("payload_json", "$.pull_request")
    parsed = bronze.select("repo_owner", "repo_name", p.alias("_p"), lab_structs.alias("_lab"), asg_structs.alias("_asg"), pr_text.alias("_pr"))
    f = lambda path: F.col(f"_p.{path}")
    nonempty = lambda c: c.isNotNull() & (c != "")
    return parsed.select(
        "repo_owner",
        "repo_name",
        F.lit(extracted_at).cast("timestamp").alias("extracted_at_utc"),
        f("id").alias("issue_id"),
        f("node_id").alias("node_id"),
        tf.try_long(f("number")).alias("issue_number"),
        f("title").alias("title"),
        f("state").alias("state"),
        f("state_reason").alias("state_reason"),
        f("created_at").alias("created_at"),
        f("updated_at").alias("updated_at"),
        f("closed_at").alias("closed_at"),
        tf.try_bool(f("locked")).alias("is_locked"),
        f("active_lock_reason").alias("active_lock_reason"),
        f("author_association").alias("author_association"),
        tf.try_long(f("comments")).alias("comment_count"),
        f("user.login").alias("author_login"),
        tf.try_long(f("user.id")).alias("author_id"),
        f("user.type").alias("author_type"),
        f("milestone.title").alias("milestone_title"),
        f("milestone.state").alias("milestone_state"),
        f("html_url").alias("html_url"),
        f("url").alias("api_url"),
        f("comments_url").alias("comments_url"),
        f("events_url").alias("events_url"),
        F.coalesce(F.size(F.json_object_keys("_pr")) > 0, F.lit(False)).alias("is_pull_request"),
        f("pull_request.url").alias("pull_request_url"),
        F.transform(
            "_lab",
            lambda s: F.struct(
                tf.try_long(s["id"]).alias("id"),
                s["name"].alias("name"),
                s["color"].alias("color"),
                s["description"].alias("description"),
                tf.try_bool(s["default"]).alias("default"),
            ),
        ).alias("labels"),
        F.transform(F.filter("_lab", lambda s: nonempty(s["name"])), lambda s: s["name"]).alias("label_names"),
        F.transform(
            "_asg",
            lambda s: F.struct(s["login"].alias("login"), tf.try_long(s["id"]).alias("id"), s["type"].alias("type")),
        ).alias("assignees"),
        F.transform(F.filter("_asg", lambda s: nonempty(s["login"])), lambda s: s["login"]).alias("assignee_logins"),
    )
