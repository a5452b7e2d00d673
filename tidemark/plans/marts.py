"""Gold marts (M1-M5) as Spark plans over the silver tables.

Dependency graph: lifecycle -> {daily flow -> swing days, closure age, weekday}.
Every mart is computed for all repositories at once with
``(repo_owner, repo_name)`` as the leading key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark import operators as ops
from tidemark.schemas import ISSUE_KEYS, REPO_KEYS



def lifecycle(
    issues: DataFrame,
    labels: DataFrame,
    assignees: DataFrame,
    run_ts: dt.datetime | str,
) -> DataFrame:
    """M1: one row per non-pull-request issue with sorted label/assignee lists.

    Children are aggregated to one row per issue *before* the joins, so both
    left joins are 1:1 on ``(repo, issue_id)``; labels and assignees are grouped
    on the same keys, which lets the joins reuse that partitioning.
    """
    lbl = ops.sorted_lists(labels, ISSUE_KEYS, "label_name", "label_names")
    asg = ops.sorted_lists(assignees, ISSUE_KEYS, "assignee_login", "assignee_logins")
    base = issues.filter(F.col("is_pull_request") == F.lit(False))
    joined = base.join(lbl, ISSUE_KEYS, "left").join(asg, ISSUE_KEYS, "left")
    return joined.select(
        "issue_id",
        "issue_node_id",
        "repo_owner",
        "repo_name",
        "issue_number",
        "title",
        "html_url",
        "state",
        "state_reason",
        "created_at",
        F.to_date("created_at").alias("created_date"),
        "closed_at",
        F.to_date("closed_at").alias("closed_date"),
        "updated_at",
        (F.col("state") == "open").alias("is_open"),
        (F.col("state") == "closed").alias("is_closed"),
        tf.closure_age_days("created_at", "closed_at").alias("closure_age_days"),
        "author_association",
        "comment_count",
        F.coalesce("label_names", tf.empty_string_array()).alias("label_names"),
        F.coalesce(tf.first_element("label_names"), F.lit("other")).alias("label_group"),
        F.coalesce("assignee_logins", tf.empty_string_array()).alias("assignee_logins"),
        F.lit(run_ts).cast("timestamp").alias("loaded_at"),
    )


def _closed_date(lc: DataFrame):
    return F.when(F.col("is_closed") == F.lit(True), F.col("closed_date"))


def daily_counts(lc: DataFrame) -> DataFrame:
    """A1+A2: opened and closed per repo and day, one scan and one shuffle."""
    return ops.daily_event_counts(
        lc,
        REPO_KEYS,
        {"opened_count": F.col("created_date"), "closed_count": _closed_date(lc)},
    )


def daily_flow(lc: DataFrame) -> DataFrame:
    """M2: dense per-repo daily spine with running and 7-day rolling totals."""
    dense = ops.densify(daily_counts(lc), REPO_KEYS, ["opened_count", "closed_count"])
    dense = dense.withColumn("net_change", F.col("opened_count") - F.col("closed_count"))
    return ops.running_and_rolling(
        dense,
        REPO_KEYS,
        "calendar_date",
        running={"cumulative_net_change": "net_change"},
        rolling={
            "rolling_7d_opened": "opened_count",
            "rolling_7d_closed": "closed_count",
            "rolling_7d_net_change": "net_change",
        },
    )


def closure_age_monthly(lc: DataFrame) -> DataFrame:
    """M3: closed count, median / p90 age and two shares per repo and month.

    Ages are whole days, so a month is a short list of (age, count): counted with
    map-side partial sums, then the discrete quantiles are read off the cumulative
    counts. Exact at every size, and a hot repository-month is a few rows.
    """
    age, month = F.col("closure_age_days"), [*REPO_KEYS, "year_month"]
    closed = lc.filter(
        (F.col("is_closed") == F.lit(True)) & F.col("closed_date").isNotNull() & age.isNotNull()
    )
    by_age = closed.groupBy(*REPO_KEYS, tf.month_start("closed_date").alias("year_month"), age.alias("age")).agg(
        F.count(F.lit(1)).alias("n"))
    upto = by_age.withColumn("upto", F.sum("n").over(Window.partitionBy(*month).orderBy("age"))).withColumn(
        "total", F.sum("n").over(Window.partitionBy(*month)))
    # the youngest age that at least the share has reached, in whole numbers (10ths)
    return upto.groupBy(*month).agg(
        F.max("total").alias("closed_issue_count"),
        F.min(F.when(F.col("upto") * 10 >= F.col("total") * 5, F.col("age"))).cast("bigint").alias("median_closure_age_days"),
        F.min(F.when(F.col("upto") * 10 >= F.col("total") * 9, F.col("age"))).cast("bigint").alias("p90_closure_age_days"),
        (F.sum(F.when(F.col("age") <= 7, F.col("n")).otherwise(0)).cast("double") / F.max("total")).alias("share_closed_within_7d"),
        (F.sum(F.when(F.col("age") > 90, F.col("n")).otherwise(0)).cast("double") / F.max("total")).alias("share_closed_after_90d"),
    )


def weekday_rhythm(lc: DataFrame) -> DataFrame:
    """M4: opened / closed counts per repo and weekday (Monday = 0); not dense."""
    events = F.array(
        F.struct(F.lit("opened").alias("event_type"), F.col("created_date").alias("d")),
        F.struct(F.lit("closed").alias("event_type"), _closed_date(lc).alias("d")),
    )
    exploded = (
        lc.select(*REPO_KEYS, F.explode(events).alias("_e"))
        .filter(F.col("_e.d").isNotNull())
        .select(*REPO_KEYS, F.col("_e.event_type").alias("event_type"), tf.weekday_num("_e.d").alias("weekday_num"))
    )
    counts = exploded.groupBy(*REPO_KEYS, "weekday_num", "event_type").agg(
        F.count(F.lit(1)).alias("issue_count")
    )
    return counts.select(
        *REPO_KEYS, "weekday_num", tf.weekday_name("weekday_num").alias("weekday_name"), "event_type", "issue_count"
    )


def swing_days(flow: DataFrame) -> DataFrame:
    """M5: RANK of each day's net change, both directions; zero days take part."""
    base = flow.select(*REPO_KEYS, "calendar_date", "opened_count", "closed_count", "net_change")
    return ops.rank_within(
        base,
        REPO_KEYS,
        {
            "swing_rank_positive": F.col("net_change").desc(),
            "swing_rank_negative": F.col("net_change").asc(),
        },
    )


def all_marts(issues: DataFrame, labels: DataFrame, assignees: DataFrame, run_ts) -> dict[str, DataFrame]:
    """Lazy plans for all five marts (callers decide what to materialize)."""
    lc = lifecycle(issues, labels, assignees, run_ts)
    flow = daily_flow(lc)
    return {
        "mart_issue_lifecycle": lc,
        "mart_issue_daily_flow": flow,
        "mart_issue_closure_age_monthly": closure_age_monthly(lc),
        "mart_issue_weekday_rhythm": weekday_rhythm(lc),
        "mart_issue_swing_days": swing_days(flow),
    }
