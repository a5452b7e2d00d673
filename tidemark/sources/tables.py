"""Issue-shaped silver tables derived from the driver's star-schema tables.

The registered queries run the library on data Spark derives from the given
tables, so their work grows with the tables:

=================  ===============================================================
issue field        derived from
=================  ===============================================================
repo_owner/name    ``region.r_name`` / ``nation.n_name`` through ``customer``
issue_id, number   ``orders.o_orderkey``
created_at         ``orders.o_orderdate``
state              ``closed`` when ``o_orderstatus = 'F'``, else ``open``
closed_at          closed orders: earliest ``l_shipdate`` not before the order date
is_pull_request    ``o_orderpriority = '1-URGENT'``
comment_count      line count of the order
label rows         distinct ``(l_orderkey, l_returnflag)``
assignee rows      distinct ``(l_orderkey, s_name)``
=================  ===============================================================

Join sizes: ``region`` and ``nation`` are fixed-size dimensions; ``customer``,
``supplier``, ``orders`` and ``lineitem`` grow with the scale factor, so no
broadcast is forced. Spark's planner and AQE broadcast a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ISSUE_KEYS


# Declared schemas of the input tables (read without per-file inference).
TABLE_DDL = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    ddl = TABLE_DDL.get(name)
    return spark.read.schema(ddl).parquet(path) if ddl else spark.read.parquet(path)


def customer_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """c_custkey -> (repo_owner, repo_name, author_association)."""
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("repo_owner"))
    nation = table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_regionkey", F.col("n_name").alias("repo_name")
    )
    repos = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "repo_owner", "repo_name"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return customer.join(repos, customer.c_nationkey == repos.n_nationkey).select(
        "c_custkey", "repo_owner", "repo_name", F.col("c_mktsegment").alias("author_association")
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
    )


def order_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey -> repo keys (the issue's repository)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = customer_repos(spark, sf_dir).select("c_custkey", "repo_owner", "repo_name")
    return orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        F.col("o_orderkey").alias("issue_id"), "repo_owner", "repo_name"
    )


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: line count, first ship not before the order date, last ship."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").cast("timestamp").alias("l_shipdate")
    )
    od = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    joined = li.join(od, li.l_orderkey == od.o_orderkey)
    return joined.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.min(F.when(F.col("l_shipdate") >= F.col("o_orderdate"), F.col("l_shipdate"))).alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


def issues(spark: SparkSession, sf_dir: str, raw_close: bool = False) -> DataFrame:
    """Issue snapshot rows (the silver ``issue_current`` columns the marts use).

    ``raw_close`` uses the last ship date as closing time even when it falls
    before the order date: that is the failing input for the time-order check.
    """
    o = _orders(spark, sf_dir)
    cust = customer_repos(spark, sf_dir)
    lf = line_facts(spark, sf_dir)
    closed = F.col("o_orderstatus") == "F"
    close_src = F.col("last_ship") if raw_close else F.col("first_ship")
    closed_at = F.when(closed, close_src)
    key = F.col("o_orderkey").cast("string")
    base = o.join(cust, o.o_custkey == cust.c_custkey).join(lf, o.o_orderkey == lf.l_orderkey, "left")
    return base.select(
        F.col("o_orderkey").alias("issue_id"),
        F.concat(F.lit("I_"), key).alias("issue_node_id"),
        "repo_owner",
        "repo_name",
        F.col("o_orderkey").alias("issue_number"),
        F.concat(F.lit("Issue "), key).alias("title"),
        F.concat(F.lit("issues/"), key).alias("html_url"),
        F.when(closed, "closed").otherwise("open").alias("state"),
        F.when(closed, "completed").alias("state_reason"),
        F.col("o_orderdate").alias("created_at"),
        closed_at.alias("closed_at"),
        F.coalesce(closed_at, F.col("o_orderdate")).alias("updated_at"),
        "author_association",
        F.coalesce("line_count", F.lit(0)).cast("bigint").alias("comment_count"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_pull_request"),
    )


def issue_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rows: distinct return flags of an order's lines, keyed like silver."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("issue_id"), F.col("l_returnflag").alias("label_name")
    )
    return li.distinct().join(order_repos(spark, sf_dir), "issue_id").select(*ISSUE_KEYS, "label_name")


def issue_assignees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignee rows: distinct supplier names of an order's lines."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    pairs = li.join(sup, li.l_suppkey == sup.s_suppkey).select(
        F.col("l_orderkey").alias("issue_id"), F.col("s_name").alias("assignee_login")
    )
    return pairs.distinct().join(order_repos(spark, sf_dir), "issue_id").select(*ISSUE_KEYS, "assignee_login")


# --------------------------------------------------------------------------
# Bronze-shaped pages built from the tables (for the silver operators)
# --------------------------------------------------------------------------

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _iso(c):
    return F.date_format(c, ISO)


def bronze_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows whose payload is the issue record as the REST API returns it.

    One landing run per order year, one page per order month; labels and
    assignees are arrays of objects (at most one per distinct line flag /
    supplier of the order); ``pull_request`` is present only for pull requests.
    """
    iss = issues(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_suppkey")
    lab = (
        li.select("l_orderkey", "l_returnflag").distinct()
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list(F.struct(
            F.ascii("l_returnflag").cast("bigint").alias("id"),
            F.col("l_returnflag").alias("name"),
            F.concat(F.lit("flag "), F.col("l_returnflag")).alias("description"),
            F.lit("ededed").alias("color"),
            F.lit(False).alias("default"),
        ))).alias("labels"))
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    asg = (
        li.select("l_orderkey", "l_suppkey").distinct()
        .join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list(F.struct(
            F.col("s_name").alias("login"),
            F.col("s_suppkey").alias("id"),
            F.lit("User").alias("type"),
        ))).alias("assignees"))
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = (
        iss.join(o, iss.issue_id == o.o_orderkey)
        .join(lab, iss.issue_id == lab.l_orderkey, "left")
        .join(asg.withColumnRenamed("l_orderkey", "a_orderkey"), F.col("issue_id") == F.col("a_orderkey"), "left")
    )
    key = F.col("issue_id").cast("string")
    payload = F.to_json(F.struct(
        F.col("issue_id").alias("id"),
        F.col("issue_node_id").alias("node_id"),
        F.col("issue_number").alias("number"),
        "title",
        "state",
        "state_reason",
        F.lit(False).alias("locked"),
        _iso("created_at").alias("created_at"),
        _iso("updated_at").alias("updated_at"),
        _iso("closed_at").alias("closed_at"),
        "html_url",
        F.concat(F.lit("api/issues/"), key).alias("url"),
        "author_association",
        F.col("comment_count").alias("comments"),
        F.struct(
            F.concat(F.lit("user"), F.col("o_custkey").cast("string")).alias("login"),
            F.col("o_custkey").alias("id"),
            F.lit("User").alias("type"),
        ).alias("user"),
        F.coalesce("labels", F.array()).alias("labels"),
        F.coalesce("assignees", F.array()).alias("assignees"),
        F.when(F.col("is_pull_request"), F.struct(
            F.concat(F.lit("api/pulls/"), key).alias("url"),
            F.concat(F.lit("pull/"), key).alias("html_url"),
        )).alias("pull_request"),
    ))
    return j.select(*_landing_columns(), payload.alias("payload_json"))


def _landing_columns():
    """One landing run per order year, one page per order month."""
    created = F.col("created_at")
    return [
        F.concat(F.lit("run_"), F.year(created).cast("string")).alias("run_id"),
        "repo_owner",
        "repo_name",
        F.month(created).cast("int").alias("page_number"),
        F.make_timestamp(F.year(created) + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("fetched_at"),
        F.col("issue_id"),
        F.col("updated_at").alias("issue_updated_at"),
    ]


def bronze_index(spark: SparkSession, sf_dir: str, issue_rows: DataFrame | None = None) -> DataFrame:
    """The bronze rows of ``bronze_pages`` without the payload text (for run
    bookkeeping: manifests, run totals, latest runs)."""
    base = issue_rows if issue_rows is not None else issues(spark, sf_dir)
    return base.select(*_landing_columns())


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned records from ``events``: key (event_type, user_id), version ts.

    Mapped onto the issue keys: repo_owner='events', repo_name=event_type,
    issue_id=user_id, updated_at=ts.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.lit("events").alias("repo_owner"),
        F.col("event_type").alias("repo_name"),
        F.col("user_id").alias("issue_id"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        "event_id",
        "value",
        "props",
    )
