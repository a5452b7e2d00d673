"""Metric queries (K1-K19) over the gold marts.

The reference answers these for one repository at a time; here every metric
is computed for all repositories in one job, keyed by ``(repo_owner,
repo_name)``. ``scope`` narrows any of them to one repository (partition
pruning when the marts are read from partitioned storage), a date range or a
label group. ``as_of`` is always a parameter, never the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark import operators as ops
from tidemark.schemas import REPO_KEYS

WINDOW_DAYS = 180
CLOSURE_SERIES_MONTHS = 24
TOP_SWING = 10
DETAIL_ROWS = 500
PREVIEW_ROWS = 10
# Averages of doubles are rounded: their last bits depend on summation order,
# which in a distributed sum depends on partitioning.
SHARE_DIGITS = 9

# Dashboard column labels for each metric output column.
DISPLAY_NAMES = {
    "cumulative_net_change": "Cumulative Net Change",
    "rolling_7d_opened": "7d Opened",
    "rolling_7d_closed": "7d Closed",
    "rolling_7d_net_change": "7d Net Change",
    "opened_count": "Opened",
    "closed_count": "Closed",
    "net_change": "Net Change",
    "median_closure_age_days": "Median Days",
    "p90_closure_age_days": "P90 Days",
    "issue_count": "Issue Count",
    "issue_number": "Issue #",
    "closure_age_days": "Closure Age (days)",
    "author_association": "Author Role",
    "label_group": "Label Group",
    "html_url": "URL",
}


def display(df: DataFrame) -> DataFrame:
    """P20: rename output columns to the dashboard's labels."""
    return df.select(*[F.col(c).alias(DISPLAY_NAMES.get(c, c)) for c in df.columns])


def _lit_date(d: dt.date | str) -> Column:
    return F.lit(d).cast("date")


def scope(
    df: DataFrame,
    repo: tuple[str, str] | None = None,
    date_col: str | None = None,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    label_group: str | None = None,
) -> DataFrame:
    """Optional repository, inclusive date range and label-group filters."""
    if repo is not None:
        df = df.filter((F.col("repo_owner") == repo[0]) & (F.col("repo_name") == repo[1]))
    if date_col is not None and start is not None:
        df = df.filter(F.col(date_col) >= _lit_date(start))
    if date_col is not None and end is not None:
        df = df.filter(F.col(date_col) <= _lit_date(end))
    if label_group is not None:
        df = df.filter(F.col("label_group") == label_group)
    return df


def window_start(as_of: dt.date | str, days: int = WINDOW_DAYS) -> Column:
    return F.date_sub(_lit_date(as_of), days)


# K1 ------------------------------------------------------------------------


def repo_names(lifecycle: DataFrame) -> DataFrame:
    """K1: the repositories present in the lifecycle mart."""
    return lifecycle.select(*REPO_KEYS).distinct()


# K2-K5 ---------------------------------------------------------------------


def _per_repository(rows: DataFrame, cond: Column, agg: Column, out: str, repos: DataFrame | None) -> DataFrame:
    """``agg`` over the rows that meet ``cond``, one row per repository, NULL for those without such rows.

    Over a stored mart, give its repositories (``repos``, such as the commit log): then ``cond`` is a filter that
    reaches the scan. Without, one pass over ``rows`` finds the repositories too.
    """
    if repos is None:
        return rows.withColumn("_in", cond).groupBy(*REPO_KEYS).agg(agg.alias(out))
    found = rows.filter(cond).withColumn("_in", F.lit(True)).groupBy(*REPO_KEYS).agg(agg.alias(out))
    return repos.select(*REPO_KEYS).distinct().join(found, list(REPO_KEYS), "left")


def opened_in_window(lifecycle: DataFrame, as_of, days: int = WINDOW_DAYS, repos: DataFrame | None = None) -> DataFrame:
    """K2: issues created on or after ``as_of - days`` (0 for quiet repositories)."""
    cond = F.col("created_date") >= window_start(as_of, days)
    return _per_repository(lifecycle, cond, F.count_if("_in").cast("bigint"), "opened_in_window", repos).na.fill(0, ["opened_in_window"])


def closed_in_window(lifecycle: DataFrame, as_of, days: int = WINDOW_DAYS, repos: DataFrame | None = None) -> DataFrame:
    """K3: closed issues with a closing day on or after ``as_of - days``."""
    cond = (F.col("is_closed") == F.lit(True)) & (F.col("closed_date") >= window_start(as_of, days))
    return _per_repository(lifecycle, cond, F.count_if("_in").cast("bigint"), "closed_in_window", repos).na.fill(0, ["closed_in_window"])


def net_change_in_window(flow: DataFrame, as_of, days: int = WINDOW_DAYS, repos: DataFrame | None = None) -> DataFrame:
    """K4: summed net change of the window's days; NULL without one, as a sum over no rows is."""
    net = F.sum(F.when(F.col("_in"), F.col("net_change"))).cast("bigint")
    return _per_repository(flow, F.col("calendar_date") >= window_start(as_of, days), net, "net_change_in_window", repos)


def backlog_direction(flow: DataFrame, as_of, days: int = WINDOW_DAYS, repos: DataFrame | None = None) -> DataFrame:
    """K5: Worsening above +10, Improving below -10, else Flat (also when NULL)."""
    net = net_change_in_window(flow, as_of, days, repos)
    return net.select(*REPO_KEYS, tf.direction_signal("net_change_in_window").alias("direction"))


# K6-K8 ---------------------------------------------------------------------


def _series(flow: DataFrame, as_of, cols: list[str], days: int) -> DataFrame:
    recent = flow.filter(F.col("calendar_date") >= window_start(as_of, days))
    return recent.select(*REPO_KEYS, "calendar_date", *cols).orderBy(*REPO_KEYS, "calendar_date")


def cumulative_series(flow: DataFrame, as_of, days: int = WINDOW_DAYS) -> DataFrame:
    """K6: running net change since the start of history, shown for the window."""
    return _series(flow, as_of, ["cumulative_net_change"], days)


def rolling_opened_closed_series(flow: DataFrame, as_of, days: int = WINDOW_DAYS) -> DataFrame:
    """K7: 7-day opened vs closed."""
    return _series(flow, as_of, ["rolling_7d_opened", "rolling_7d_closed"], days)


def rolling_net_series(flow: DataFrame, as_of, days: int = WINDOW_DAYS) -> DataFrame:
    """K8: 7-day net change (backlog velocity)."""
    return _series(flow, as_of, ["rolling_7d_net_change"], days)


# K9-K10 --------------------------------------------------------------------


def top_swing_days(swing: DataFrame, direction: str = "positive", k: int = TOP_SWING) -> DataFrame:
    """Days ranked within the top ``k`` (ties included, so maybe more rows)."""
    rank = f"swing_rank_{direction}"
    out = swing.filter(F.col(rank) <= k)
    return out.select(*REPO_KEYS, "calendar_date", "opened_count", "closed_count", "net_change", rank).orderBy(
        *REPO_KEYS, rank, "calendar_date"
    )


# K11-K13 -------------------------------------------------------------------


def closure_age_series(monthly: DataFrame, as_of, months: int = CLOSURE_SERIES_MONTHS) -> DataFrame:
    """Monthly median and p90 closure age for the last ``months`` months."""
    since = F.add_months(_lit_date(as_of), -months)
    recent = monthly.filter(F.col("year_month") >= since)
    return recent.select(*REPO_KEYS, "year_month", "median_closure_age_days", "p90_closure_age_days").orderBy(
        *REPO_KEYS, "year_month"
    )


def mean_share(monthly: DataFrame, share: str) -> DataFrame:
    """Unweighted mean of the monthly shares."""
    return monthly.groupBy(*REPO_KEYS).agg(F.round(F.avg(share), SHARE_DIGITS).alias(f"avg_{share}"))


# K14-K15 -------------------------------------------------------------------


def weekday_bars(weekday: DataFrame, event_type: str) -> DataFrame:
    """Counts per weekday for one event type, Monday first."""
    rows = weekday.filter(F.col("event_type") == event_type)
    return rows.select(*REPO_KEYS, "weekday_num", "weekday_name", "issue_count").orderBy(*REPO_KEYS, "weekday_num")


# K16-K17 -------------------------------------------------------------------


def issue_detail(lifecycle: DataFrame, k: int = DETAIL_ROWS) -> DataFrame:
    """Newest ``k`` issues per repository, newest first (tie key: issue id)."""
    order = [F.col("created_at").desc_nulls_last(), F.col("issue_id").desc()]
    top = ops.top_k_per_group(lifecycle, REPO_KEYS, order, k)
    return top.select(
        *REPO_KEYS,
        "issue_id",
        "issue_number",
        "title",
        "created_at",
        "closed_at",
        "state",
        "closure_age_days",
        "author_association",
        "label_group",
        "html_url",
    )


def open_backlog_preview(lifecycle: DataFrame, k: int = PREVIEW_ROWS) -> DataFrame:
    """Most recently updated open issues per repository, latest first."""
    open_rows = lifecycle.filter(F.col("is_open") == F.lit(True))
    order = [F.col("updated_at").desc_nulls_last(), F.col("issue_id").desc()]
    top = ops.top_k_per_group(open_rows, REPO_KEYS, order, k)
    return top.select(
        *REPO_KEYS,
        "issue_id",
        "issue_number",
        "title",
        "state",
        "created_at",
        "updated_at",
        "comment_count",
        "label_names",
        "assignee_logins",
        "html_url",
    )


def recently_updated(shaped: DataFrame, k: int = PREVIEW_ROWS) -> DataFrame:
    """L3: the ``k`` most recently updated rows per repository, pull requests included."""
    order = [F.col("updated_at").desc_nulls_last(), F.col("issue_id").desc()]
    top = ops.top_k_per_group(shaped, REPO_KEYS, order, k)
    return top.select(*REPO_KEYS, "issue_id", "issue_number", "title", "state", "created_at", "updated_at", "is_pull_request")


# K18-K19 -------------------------------------------------------------------


def count_by_state(issues: DataFrame) -> DataFrame:
    """Non-pull-request issues per state, the most frequent state first."""
    rows = issues.filter(F.col("is_pull_request") == F.lit(False))
    counts = rows.groupBy(*REPO_KEYS, "state").agg(F.count(F.lit(1)).alias("issue_count"))
    return counts.orderBy(*REPO_KEYS, F.col("issue_count").desc(), "state")


def issue_totals(issues: DataFrame) -> DataFrame:
    """All rows and pull-request rows per repository."""
    return issues.groupBy(*REPO_KEYS).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_pull_request") == F.lit(True)).cast("bigint").alias("pull_request_rows"),
        F.count_if(F.col("is_pull_request") == F.lit(False)).cast("bigint").alias("true_issue_rows"),
    )


def list_breakdown(lifecycle: DataFrame, list_col: str, out: str) -> DataFrame:
    """Issues per label (or assignee), open and total."""
    exploded = lifecycle.select(*REPO_KEYS, "is_open", F.explode(list_col).alias(out))
    return exploded.groupBy(*REPO_KEYS, out).agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.count_if(F.col("is_open") == F.lit(True)).cast("bigint").alias("open_issue_count"),
    )


def label_group_breakdown(lifecycle: DataFrame) -> DataFrame:
    """Issues per label group, open and total."""
    return lifecycle.groupBy(*REPO_KEYS, "label_group").agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.count_if(F.col("is_open") == F.lit(True)).cast("bigint").alias("open_issue_count"),
    )


# P16 / P22 -------------------------------------------------------------------


def register_open_backlog_view(lifecycle: DataFrame, name: str = "v_open_backlog_snapshot") -> None:
    """A temp view of open, non-pull-request issues (the mart excludes PRs)."""
    lifecycle.filter(F.col("is_open") == F.lit(True)).select(
        "issue_id", "issue_number", "title", "state", "created_at", "updated_at", "comment_count",
        "label_names", "assignee_logins", "html_url", *REPO_KEYS,
    ).createOrReplaceTempView(name)


def opened_in_window_sql(spark, view: str, owner: str, name: str, as_of, days: int = WINDOW_DAYS) -> DataFrame:
    """The K2 metric through the SQL API with bound (not spliced) parameters."""
    return spark.sql(
        f"SELECT COUNT(*) AS opened_in_window FROM {view} "
        "WHERE repo_owner = :owner AND repo_name = :name AND created_date >= date_sub(:as_of, :days)",
        args={"owner": owner, "name": name, "as_of": _as_date(as_of), "days": days},
    )


def _as_date(d):
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))
