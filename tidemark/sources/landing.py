"""Land raw issue pages.

Input: page files as returned by the tracker's REST API, one JSON array of
issue records per file, laid out as
``<pages>/repo_owner=<o>/repo_name=<n>/run_id=<r>/page_<NNN>.json``.
All repositories and runs are read in one parallel scan (one task per file
split; a page holds at most one API page of records), flattened to one bronze
row per record with the record's JSON text kept whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as tf
from tidemark.schemas import REPO_KEYS


def read_page_files(spark: SparkSession, pages_dir: str) -> DataFrame:
    """One row per page file: repo, run, page number, fetch time and records."""
    raw = (
        spark.read.option("wholetext", True)
        .option("pathGlobFilter", "page_*.json")
        .text(pages_dir)
        .select(
            "repo_owner",
            "repo_name",
            "run_id",
            # a name without a number is a rejected page
            F.regexp_extract("_metadata.file_name", r"page_(\d+)", 1).try_cast("int").alias("page_number"),
            F.col("_metadata.file_modification_time").alias("fetched_at"),
            F.from_json("value", "array<string>").alias("records"),
        )
    )
    return raw.withColumn("records", F.when(F.col("page_number").isNotNull(), F.col("records")))


def apply_since(pages: DataFrame, since) -> DataFrame:
    """``pages`` with ``since`` and without the records updated before it.

    ``since`` is a time for every repository, or a table (repo keys, since) with a row for each repository
    that has one; a repository without (never synced) keeps all records. A record whose update time cannot be
    read is kept. The table is one row per repository, so Spark broadcasts it while it is small.
    """
    if isinstance(since, DataFrame):
        marked = pages.join(since.select(*REPO_KEYS, F.col("since").cast("timestamp").alias("since")), list(REPO_KEYS), "left")
    else:
        marked = pages.withColumn("since", F.lit(since).cast("timestamp"))
    recent = F.filter("records", lambda r: F.coalesce(
        tf.try_timestamp(F.get_json_object(r, "$.updated_at")) >= F.col("since"), F.lit(True)))
    return marked.withColumn("records", F.when(F.col("since").isNull(), F.col("records")).otherwise(recent))


def bronze_rows(pages: DataFrame) -> DataFrame:
    """One row per record; a page that is not a JSON array contributes no rows."""
    rows = pages.select(
        "run_id",
        *REPO_KEYS,
        "page_number",
        "fetched_at",
        F.explode(F.transform("records", tf.canonical_json)).alias("payload_json"),
    )
    return rows.select(
        "run_id",
        *REPO_KEYS,
        "page_number",
        "fetched_at",
        tf.try_long(F.get_json_object("payload_json", "$.id")).alias("issue_id"),
        tf.try_timestamp(F.get_json_object("payload_json", "$.updated_at")).alias("issue_updated_at"),
        "payload_json",
    )


def manifests_for(pages: DataFrame, finished_at) -> DataFrame:
    """Manifest rows per landed run (A23) of ``pages`` after ``apply_since``; empty pages count no page and no record.

    Every page of a run is landed, so ``truncated`` is always false.
    """
    n = F.coalesce(F.size("records"), F.lit(0))
    updated = F.aggregate(
        F.transform(F.coalesce("records", F.array().cast("array<string>")),
                    lambda r: tf.try_timestamp(F.get_json_object(r, "$.updated_at"))),
        F.lit(None).cast("timestamp"),
        lambda acc, x: F.greatest(acc, x),
    )
    # H8: malformed input is counted, never silently lost: a page that is not
    # a JSON array, and records without an id (they never reach silver).
    no_id = F.size(F.filter(F.coalesce("records", F.array().cast("array<string>")),
                            lambda r: tf.try_long(F.get_json_object(r, "$.id")).isNull()))
    per_run = pages.groupBy(*REPO_KEYS, "run_id").agg(
        F.count_if(F.col("records").isNull()).cast("bigint").alias("rejected_pages"),
        F.sum(no_id).cast("bigint").alias("rejected_records"),
        F.min("fetched_at").alias("started_at"),
        F.min("since").alias("since"),
        F.count_if(n > 0).cast("bigint").alias("pages_fetched"),
        F.sum(n).cast("bigint").alias("records_fetched"),
        F.max(updated).alias("max_issue_updated_at"),
    )
    return per_run.select(
        "run_id",
        *REPO_KEYS,
        F.lit("success").alias("status"),
        "started_at",
        F.lit(finished_at).cast("timestamp").alias("finished_at"),
        "since",
        "pages_fetched",
        "records_fetched",
        "max_issue_updated_at",
        F.lit(None).cast("string").alias("final_url"),
        F.lit(False).alias("truncated"),
        "rejected_pages",
        "rejected_records",
    )
