"""Declared schemas: every table is read and written with one of these.

Declaring the schema once (instead of inferring it per file) makes readers
tolerant of schema evolution: columns missing in older files read as NULL and
type drift is handled by ``try_cast`` on entry.
"""

from __future__ import annotations

from pyspark.sql import types as T

REPO_KEYS = ["repo_owner", "repo_name"]
ISSUE_KEYS = REPO_KEYS + ["issue_id"]


_DDL: dict[str, str] = {}
_PARSED: dict[str, T.StructType] = {}


def _struct(spec: str) -> str:
    return spec


def __getattr__(name: str) -> T.StructType:
    """Schemas are declared as DDL text and turned into StructTypes on first use.

    Spark parses DDL with the active session, so parsing waits until one exists.
    """
    if name not in _DDL:
        raise AttributeError(name)
    if name not in _PARSED:
        _PARSED[name] = T._parse_datatype_string(_DDL[name])  # noqa: SLF001
    return _PARSED[name]


# Issue record as delivered by the tracker's REST API (the JSON payload).
# Times stay strings here and are parsed with try_cast after from_json, so one
# malformed time nulls one field and keeps the row. Labels and assignees are
# kept as raw JSON element text so that their own fields can be parsed leniently.
_DDL["ISSUE_PAYLOAD"] = _struct(
    "id BIGINT, node_id STRING, number STRING, title STRING, state STRING, "
    "state_reason STRING, locked STRING, active_lock_reason STRING, "
    "created_at STRING, updated_at STRING, closed_at STRING, html_url STRING, "
    "url STRING, comments_url STRING, events_url STRING, author_association STRING, "
    "comments STRING, user STRUCT<login: STRING, id: STRING, type: STRING>, "
    "labels STRING, assignees STRING, milestone STRUCT<title: STRING, state: STRING>, "
    "closed_by STRUCT<login: STRING>, performed_via_github_app STRUCT<name: STRING>, "
    "pull_request STRUCT<url: STRING, html_url: STRING>, body STRING"
)

_DDL["LABEL_ELEMENT"] = _struct("id STRING, name STRING, description STRING, color STRING, default STRING")
_DDL["ASSIGNEE_ELEMENT"] = _struct("login STRING, id STRING, type STRING")

_DDL["BRONZE_PAGES"] = _struct(
    "run_id STRING, repo_owner STRING, repo_name STRING, page_number INT, "
    "fetched_at TIMESTAMP, issue_id BIGINT, issue_updated_at TIMESTAMP, payload_json STRING"
)

_DDL["MANIFESTS"] = _struct(
    "run_id STRING, repo_owner STRING, repo_name STRING, status STRING, "
    "started_at TIMESTAMP, finished_at TIMESTAMP, since TIMESTAMP, pages_fetched BIGINT, "
    "records_fetched BIGINT, max_issue_updated_at TIMESTAMP, final_url STRING, truncated BOOLEAN, "
    "rejected_pages BIGINT, rejected_records BIGINT"
)

_DDL["MERGED_RUNS"] = _struct(
    "repo_owner STRING, repo_name STRING, run_id STRING, finished_at TIMESTAMP, version STRING"
)

_DDL["ISSUE_CURRENT"] = _struct(
    "issue_id BIGINT, issue_node_id STRING, repo_owner STRING, repo_name STRING, "
    "issue_number BIGINT, title STRING, state STRING, state_reason STRING, is_locked BOOLEAN, "
    "active_lock_reason STRING, created_at TIMESTAMP, updated_at TIMESTAMP, closed_at TIMESTAMP, "
    "html_url STRING, api_url STRING, comments_url STRING, events_url STRING, "
    "author_association STRING, comment_count BIGINT, is_pull_request BOOLEAN, "
    "author_login STRING, author_id BIGINT, author_type STRING, assignee_count BIGINT, "
    "milestone_title STRING, closed_by_login STRING, performed_via_github_app_name STRING, "
    "pull_request_url STRING, pull_request_html_url STRING, body STRING, "
    "record_loaded_at TIMESTAMP, source_run_id STRING, source_recorded_at TIMESTAMP, "
    "source_page_number INT, source_payload_json STRING"
)

_DDL["ISSUE_LABELS"] = _struct(
    "issue_id BIGINT, repo_owner STRING, repo_name STRING, label_id BIGINT, label_name STRING, "
    "label_description STRING, label_color STRING, label_is_default BOOLEAN, "
    "record_loaded_at TIMESTAMP"
)

_DDL["ISSUE_ASSIGNEES"] = _struct(
    "issue_id BIGINT, repo_owner STRING, repo_name STRING, assignee_login STRING, "
    "assignee_id BIGINT, assignee_type STRING, record_loaded_at TIMESTAMP"
)

# Append-only commit log; the public sync_state is its latest row per repo.
_DDL["SYNC_LOG"] = _struct(
    "repo_owner STRING, repo_name STRING, endpoint_name STRING, "
    "last_successful_watermark_updated_at TIMESTAMP, last_successful_run_finished_at TIMESTAMP, "
    "last_successful_bronze_run_id STRING, version STRING, committed_at TIMESTAMP"
)

_DDL["GOLD_LOG"] = _struct(
    "repo_owner STRING, repo_name STRING, version STRING, committed_at TIMESTAMP, silver_version STRING"
)

_DDL["MART_LIFECYCLE"] = _struct(
    "issue_id BIGINT, issue_node_id STRING, repo_owner STRING, repo_name STRING, "
    "issue_number BIGINT, title STRING, html_url STRING, state STRING, state_reason STRING, "
    "created_at TIMESTAMP, created_date DATE, closed_at TIMESTAMP, closed_date DATE, "
    "updated_at TIMESTAMP, is_open BOOLEAN, is_closed BOOLEAN, closure_age_days BIGINT, "
    "author_association STRING, comment_count BIGINT, label_names ARRAY<STRING>, "
    "label_group STRING, assignee_logins ARRAY<STRING>, loaded_at TIMESTAMP"
)

_DDL["MART_DAILY_FLOW"] = _struct(
    "repo_owner STRING, repo_name STRING, calendar_date DATE, opened_count BIGINT, "
    "closed_count BIGINT, net_change BIGINT, cumulative_net_change BIGINT, "
    "rolling_7d_opened BIGINT, rolling_7d_closed BIGINT, rolling_7d_net_change BIGINT"
)

_DDL["MART_CLOSURE_MONTHLY"] = _struct(
    "repo_owner STRING, repo_name STRING, year_month DATE, closed_issue_count BIGINT, "
    "median_closure_age_days BIGINT, p90_closure_age_days BIGINT, "
    "share_closed_within_7d DOUBLE, share_closed_after_90d DOUBLE"
)

_DDL["MART_WEEKDAY"] = _struct(
    "repo_owner STRING, repo_name STRING, weekday_num BIGINT, weekday_name STRING, "
    "event_type STRING, issue_count BIGINT"
)

_DDL["MART_SWING"] = _struct(
    "repo_owner STRING, repo_name STRING, calendar_date DATE, opened_count BIGINT, "
    "closed_count BIGINT, net_change BIGINT, swing_rank_positive BIGINT, swing_rank_negative BIGINT"
)

# Table name -> schema constant name.
SILVER_TABLES = {
    "issue_current": "ISSUE_CURRENT",
    "issue_labels": "ISSUE_LABELS",
    "issue_assignees": "ISSUE_ASSIGNEES",
}

GOLD_TABLES = {
    "mart_issue_lifecycle": "MART_LIFECYCLE",
    "mart_issue_daily_flow": "MART_DAILY_FLOW",
    "mart_issue_closure_age_monthly": "MART_CLOSURE_MONTHLY",
    "mart_issue_weekday_rhythm": "MART_WEEKDAY",
    "mart_issue_swing_days": "MART_SWING",
}


def schema_of(name: str) -> T.StructType:
    return __getattr__(name)
