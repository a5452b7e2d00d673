"""Registered queries of landing, merging and checking, over faulty and drifted data derived from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans import marts, quality
from tidemark.plans import silver as sv
from tidemark.plans.queries import QUALITY_ISSUE_COLUMNS, RUN_TS, _sync, derived_manifests, materialize, register
from tidemark.schemas import ISSUE_KEYS, REPO_KEYS
from tidemark.sources import landing, storage, tables

# Fixed values of the derived data: when the last synchronisation was, a repository it never reached, orders of a page.
SYNCED = dt.datetime(1998, 1, 1)
UNSYNCED = "NATION_3"
PAGE_ORDERS = 400


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived bronze payloads as page files would hold them: a page has an array of at most ``PAGE_ORDERS`` records."""
    rows = tables.bronze_pages(spark, sf_dir).withColumn("page_number", F.expr(f"cast(issue_id div {PAGE_ORDERS} as int)"))
    return rows.groupBy(*REPO_KEYS, "run_id", "page_number", "fetched_at").agg(F.collect_list("payload_json").alias("records"))


@register("incremental_land")
def incremental_land(spark, sf_dir):
    """The manifests of all runs when each repository lands from its watermark, and one from the start."""
    known = tables.issues(spark, sf_dir).filter((F.col("created_at") < F.lit(SYNCED)) & (F.col("repo_name") != UNSYNCED))
    since = sv.watermark_since(_sync(spark, sf_dir, issues=known))
    pages = landing.apply_since(page_rows(spark, sf_dir), since)
    return landing.manifests_for(pages, RUN_TS).select(
        *REPO_KEYS, "run_id", "since", "pages_fetched", "records_fetched", "max_issue_updated_at", "rejected_pages", "rejected_records")


@register("drifted_bronze")
def drifted_bronze(spark, sf_dir):
    """Landed pages whose files hold times and numbers as text or typed, in one run; cast on read."""
    from tidemark.streaming.incremental import scratch

    location = scratch(spark, "drifted")
    rows = tables.bronze_index(spark, sf_dir)
    odd = F.col("issue_id") % 2 == 1
    text = rows.filter(odd).select(
        *REPO_KEYS, "run_id", F.col("page_number").cast("string").alias("page_number"), F.col("issue_id").cast("string").alias("issue_id"),
        F.date_format("fetched_at", tables.ISO).alias("fetched_at"),
        F.when(F.col("issue_id") % 10 == 1, "no time").otherwise(F.date_format("issue_updated_at", tables.ISO)).alias("issue_updated_at"))
    for part in (rows.filter(~odd), text):
        part.write.mode("append").partitionBy(*REPO_KEYS, "run_id").parquet(location)
    wanted = rows.select(*REPO_KEYS, "run_id").distinct().filter("run_id >= 'run_1997'")
    return storage.read_drifted(spark, location, schemas.BRONZE_PAGES, [*REPO_KEYS, "run_id"], wanted)


@register("canonical_payload")
def canonical_payload(spark, sf_dir):
    """two texts of each record, whose keys stand in another order, become one payload and one winner."""
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    who = F.struct(F.col("o_custkey").alias("id"), F.lit("User").alias("type"))
    one = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"), who.alias("user")))
    user = F.concat(F.lit('{ "type":"User", "id":'), F.col("o_custkey").cast("string"), F.lit("}"))
    other = F.concat(F.lit('{"user" : '), user, F.lit(', "state":"'), F.col("o_orderstatus"), F.lit('", "id": '),
                     F.col("o_orderkey").cast("string"), F.lit("}"))
    pages = orders.select(
        F.lit("r1").alias("run_id"), F.lit("o").alias("repo_owner"), F.lit("n").alias("repo_name"), F.lit(1).alias("page_number"),
        F.lit(RUN_TS).cast("timestamp").alias("fetched_at"), F.array(one, other).alias("records"))
    merged = sv.merge_current(None, sv.flatten(landing.bronze_rows(pages), RUN_TS), RUN_TS)
    texts = landing.bronze_rows(pages).groupBy("issue_id").agg(F.countDistinct("payload_json").alias("texts"))
    return merged.join(texts, "issue_id").select("issue_id", "state", "author_id", "source_payload_json", "texts")


def second_delivery(bronze: DataFrame) -> DataFrame:
    """Another version of each bronze record: per issue the merge is decided by another of its five keys."""
    kind = F.col("issue_id") % 7
    old, new = F.col("issue_updated_at"), F.col("issue_updated_at") + F.expr("INTERVAL 1 DAY") * F.when(kind == 0, 1).when(kind == 1, -1).otherwise(0)

    def stamped(time: Column) -> Column:
        return F.concat(F.lit('"updated_at":"'), F.date_format(time, tables.ISO), F.lit('"'))

    title = F.concat(F.lit('"title":"Issue '), F.col("issue_id").cast("string"))
    payload = F.replace(F.replace("payload_json", stamped(old), stamped(new)), F.concat(title, F.lit('"')), F.concat(title, F.lit('#"')))
    return bronze.withColumns({
        "payload_json": F.when(kind == 6, F.col("payload_json")).otherwise(payload),
        "issue_updated_at": new,
        "fetched_at": F.col("fetched_at") + F.expr("INTERVAL 1 HOUR") * F.when(kind == 2, 1).otherwise(0),
        "run_id": F.when(kind == 3, "run_0").otherwise(F.col("run_id")),
        "page_number": F.col("page_number") + F.when(kind == 4, 1).otherwise(0)})


@register("merge_current_runs")
def merge_current_runs(spark, sf_dir):
    """A snapshot merged with a delta by the merge of the pipeline, ties in each of its five keys included.

    The bronze rows are derived once and written, as a landing is, and so is the snapshot. Otherwise the tasks of the
    last stage would hold the buffers of all joins and sorts of both sides at once.
    """
    bronze = materialize(spark, tables.bronze_pages(spark, sf_dir))
    existing = materialize(spark, sv.merge_current(None, sv.flatten(bronze.filter("issue_id % 11 <> 5"), RUN_TS), RUN_TS))
    delta = sv.flatten(second_delivery(bronze.filter("issue_id % 13 <> 6")), RUN_TS)
    return sv.merge_current(existing, delta, RUN_TS).select(
        *ISSUE_KEYS, "title", "updated_at", "source_recorded_at", "source_run_id", "source_page_number")


@register("dq_silver_dirty")
def dq_silver_dirty(spark, sf_dir):
    """D1-D6 over a snapshot with seeded faults: each check finds some."""
    key = F.col("issue_id")
    copies = F.explode(F.when(key % 89 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    issues = tables.issues(spark, sf_dir, raw_close=True).select(*QUALITY_ISSUE_COLUMNS).filter(key % 83 != 2)
    issues = issues.withColumn("copy", copies).drop("copy").withColumn("issue_id", F.when(key % 97 != 0, key))
    issues = materialize(spark, issues)
    manifests = derived_manifests(spark, sf_dir, issues)
    kind = F.regexp_extract("repo_name", "([0-9]+)$", 1).cast("int") % 5
    second, day = F.expr("INTERVAL 1 SECOND"), F.expr("INTERVAL 1 DAY")
    state = _sync(spark, sf_dir, issues=issues, manifests=manifests).filter(kind != 1).withColumns({
        "last_successful_bronze_run_id": F.when(kind == 2, "run_x").otherwise(F.col("last_successful_bronze_run_id")),
        "last_successful_watermark_updated_at": F.when(kind != 3, F.col("last_successful_watermark_updated_at")),
        "last_successful_run_finished_at": F.col("last_successful_run_finished_at") - F.when(kind == 4, second).otherwise(second * 0)})
    return quality.silver_report(issues, tables.issue_labels(spark, sf_dir), tables.issue_assignees(spark, sf_dir), state, manifests)


@register("dq_gold_dirty")
def dq_gold_dirty(spark, sf_dir):
    """D7-D9 over marts with seeded faults: pull requests among the issues, issues and days left out."""
    issues = materialize(spark, tables.issues(spark, sf_dir).select(*ISSUE_KEYS, "created_at", "closed_at", "state", "is_pull_request"))
    days = issues.select(*ISSUE_KEYS, "is_pull_request", F.to_date("created_at").alias("created_date"),
                         F.to_date("closed_at").alias("closed_date"), (F.col("state") == "closed").alias("is_closed"))
    clean = days.filter(~F.col("is_pull_request"))
    key = F.col("issue_id")
    faulty = clean.filter(key % 73 != 1).unionByName(days.filter(F.col("is_pull_request") & (key % 71 == 0)))
    odd = F.regexp_extract("repo_name", "([0-9]+)$", 1).cast("int") % 2 == 1
    flow = marts.daily_flow(clean).filter(~(odd & (F.dayofmonth("calendar_date") == 15)))
    return quality.gold_report(faulty.select(*ISSUE_KEYS), flow, issues)
