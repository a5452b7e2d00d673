"""Storage layout, readers and writers.

Layout under one base URI (``file:``, ``s3a:``, ``abfss:`` ... the Hadoop
filesystem decides)::

    bronze/issues/repo_owner=/repo_name=/run_id=/part-*.parquet    landed pages
    bronze/manifests/part-*.parquet                                 run log, append-only
    silver/<table>/repo_owner=/repo_name=/version=/part-*.parquet   versioned snapshots
    silver/sync_log/part-*.parquet                                  commit log, append-only
    gold/<mart>/repo_owner=/repo_name=/version=/part-*.parquet      versioned marts
    gold/commit_log/part-*.parquet                                  commit log, append-only

A table is never overwritten in place (overwriting a path that the same job
reads destroys it, and dynamic partition overwrite keeps stale partitions that
received no rows). Each run appends a new ``version=`` directory; appending one
commit row per repository to an append-only log makes it visible. Readers take
each repository's latest committed version. A failed run leaves only an
uncommitted version, which no reader sees.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import operators as ops
from tidemark import schemas
from tidemark.schemas import REPO_KEYS


def path(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def is_missing_path(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (exc.getCondition() or "") or "Path does not exist" in str(exc)


def read_or_none(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame | None:
    """Read with a declared schema; ``None`` when the path does not exist.

    Only a missing path is tolerated; any other failure (corrupt files,
    permissions) propagates, so callers fail closed (I2).
    """
    try:
        return spark.read.schema(schema).parquet(location)
    except AnalysisException as exc:
        if is_missing_path(exc):
            return None
        raise


def read_or_empty(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    """The table, or a typed empty frame with the declared schema."""
    df = read_or_none(spark, location, schema)
    return df if df is not None else spark.createDataFrame([], schema)


def read_drifted(spark: SparkSession, location: str, schema: T.StructType, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """The rows of the partitions in ``wanted`` (``keys``), cast on read to ``schema`` by name with ``try_cast``.

    Files that were written with other types than declared (a time as text) are grouped by their own schema, each
    group is read with it and cast, and the groups are united by name; a missing column is NULL. Whether the types of
    the files differ is found by Spark's own merge of their footers; only if it fails are the files looked at one by
    one, in tasks. Their paths reach the driver, as those of any scan do.
    """
    folders = spark.read.option("basePath", location)
    parts = "/".join([location.rstrip("/"), *[f"{k}=*" for k in keys]])

    def cast(df: DataFrame) -> DataFrame:
        return ops.conform(df, schema).join(wanted.select(*keys), list(keys), "left_semi")

    def types_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [str(pq.read_schema(pa.BufferReader(c.as_buffer())).remove_metadata()) for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["path", "types"])

    try:
        return cast(folders.option("mergeSchema", True).parquet(parts))
    except (PySparkException, Py4JJavaError) as exc:
        if isinstance(exc, AnalysisException) and is_missing_path(exc):
            return spark.createDataFrame([], schema)
        if "CANNOT_MERGE" not in str(exc):
            raise
    files = spark.read.format("binaryFile").option("basePath", location).option("pathGlobFilter", "*.parquet").load(parts)
    files = files.join(wanted.select(*keys), list(keys), "left_semi").select("path", "content")
    types = files.mapInArrow(types_of, "path string, types string")
    groups = types.groupBy("types").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("types").collect()
    if not groups:
        return spark.createDataFrame([], schema)
    plain = spark.read.option("basePath", location).option("mergeSchema", False)
    return reduce(DataFrame.unionByName, [cast(plain.parquet(*g["paths"])) for g in groups])


def with_partitions(schema: T.StructType, *names: str) -> T.StructType:
    present = {f.name for f in schema.fields}
    extra = [T.StructField(n, T.StringType()) for n in names if n not in present]
    return T.StructType(schema.fields + extra)


# --------------------------------------------------------------------------
# Append-only logs
# --------------------------------------------------------------------------


def append(df: DataFrame, location: str) -> None:
    """S3: append rows; never a read-modify-write of the existing log."""
    df.write.mode("append").parquet(location)


def latest_commits(spark: SparkSession, log_location: str, schema: T.StructType) -> DataFrame | None:
    """Latest commit row per repository (the public one-row-per-repo state)."""
    log = read_or_none(spark, log_location, schema)
    if log is None:
        return None
    # a version starts with its sequence number, whatever clock its writer had
    return ops.latest_by_key(log, REPO_KEYS, [F.col("version").desc_nulls_last()])


class CommitConflict(RuntimeError):
    """Another writer committed a version that this one has not read."""


def next_sequence(spark: SparkSession, log_location: str, schema: T.StructType) -> int:
    """One above the highest sequence number in a commit log."""
    log = read_or_none(spark, log_location, schema)
    if log is None:
        return 1
    last = log.agg(F.max(F.substring_index("version", "-", 1).try_cast("bigint")).alias("last")).first()["last"]
    return (last or 0) + 1


def commit(rows: DataFrame, log_location: str, schema: T.StructType, sequence: int) -> None:
    """Append commit rows, unless the log already has this or a later sequence number for one of
    their repositories: then what was read for this version is out of date."""
    log = read_or_none(rows.sparkSession, log_location, schema)
    if log is not None:
        newer = log.filter(F.substring_index("version", "-", 1).try_cast("bigint") >= sequence)
        if not newer.join(rows.select(*REPO_KEYS).distinct(), list(REPO_KEYS), "left_semi").isEmpty():
            raise CommitConflict(f"sequence {sequence} or a later one is already committed in {log_location}")
    append(rows, log_location)


# --------------------------------------------------------------------------
# Versioned tables
# --------------------------------------------------------------------------


def write_version(df: DataFrame, location: str, version: str, order: Sequence[str] = ()) -> None:
    """Add one new version directory per repository present in ``df``.

    L1: rows are written in ``order`` within each file, so a filter on its first column skips row groups.

    The ``rebalance`` hint groups rows by repository before the partitioned
    write (few, well-sized files per repository instead of one per task and
    repository); AQE splits a hot repository's partition into several tasks.
    """
    (
        df.withColumn("version", F.lit(version))
        .hint("rebalance", "repo_owner", "repo_name")
        .sortWithinPartitions("repo_owner", "repo_name", "version", *order)
        .write.mode("append")
        .partitionBy("repo_owner", "repo_name", "version")
        .parquet(location)
    )


def read_committed(
    spark: SparkSession,
    location: str,
    schema: T.StructType,
    commits: DataFrame | None,
) -> DataFrame:
    """Rows of each repository's committed version; typed empty when none.

    The commit pointer table is one row per repository, so the semi-join is
    planned as a broadcast and the repo/version partition filters prune the
    scan dynamically (only committed version directories are read).
    """
    full = with_partitions(schema, "version")
    if commits is None:
        return spark.createDataFrame([], schema)
    # Only the partition folders are read (a stray file at the table root
    # with another schema is ignored).
    try:
        df = spark.read.schema(full).option("basePath", location).parquet(
            f"{location.rstrip('/')}/repo_owner=*/repo_name=*/version=*"
        )
    except AnalysisException as exc:
        if is_missing_path(exc):
            return spark.createDataFrame([], schema)
        raise
    pointer = commits.select(*REPO_KEYS, "version")
    return df.join(pointer, [*REPO_KEYS, "version"], "left_semi").select(*schema.fieldNames())


class Lake:
    """The pipeline's tables under one base URI."""

    # Spark setting naming the lake root (any Hadoop URI: file:, s3a:, abfss:, gs: ...).
    BASE_CONF = "spark.tidemark.base"

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    @classmethod
    def from_conf(cls, spark: SparkSession) -> "Lake":
        """The lake under the root named by the session setting ``spark.tidemark.base``."""
        base = spark.conf.get(cls.BASE_CONF, None)
        if not base:
            raise ValueError(f"set {cls.BASE_CONF} to the lake root URI")
        return cls(spark, base)

    # locations
    @property
    def bronze(self) -> str:
        return path(self.base, "bronze", "issues")

    @property
    def manifests(self) -> str:
        return path(self.base, "bronze", "manifests")

    def silver_table(self, name: str) -> str:
        return path(self.base, "silver", name)

    @property
    def merged_log(self) -> str:
        return path(self.base, "silver", "merged_runs")

    @property
    def sync_log(self) -> str:
        return path(self.base, "silver", "sync_log")

    def gold_table(self, name: str) -> str:
        return path(self.base, "gold", name)

    @property
    def gold_log(self) -> str:
        return path(self.base, "gold", "commit_log")

    # readers
    def read_bronze(self, runs: DataFrame | None = None) -> DataFrame:
        """Landed rows; of ``runs`` (repo keys, run_id), if given, cast on read."""
        if runs is None:
            return read_or_empty(self.spark, self.bronze, schemas.BRONZE_PAGES)
        return read_drifted(self.spark, self.bronze, schemas.BRONZE_PAGES, [*REPO_KEYS, "run_id"], runs)

    def read_manifests(self) -> DataFrame:
        return read_or_empty(self.spark, self.manifests, schemas.MANIFESTS)

    def merged_runs(self) -> DataFrame | None:
        """The runs that committed versions contain; a failed merge's rows have no committed version."""
        schema = schemas.schema_of("MERGED_RUNS")
        merged = read_or_none(self.spark, self.merged_log, schema)
        log = read_or_none(self.spark, self.sync_log, schemas.SYNC_LOG)
        if merged is None or log is None:
            return None
        return merged.join(log.select(*REPO_KEYS, "version"), [*REPO_KEYS, "version"], "left_semi")

    def sync_state(self) -> DataFrame | None:
        return latest_commits(self.spark, self.sync_log, schemas.SYNC_LOG)

    def pinned(self, commits: DataFrame | None) -> DataFrame | None:
        """Commit rows as of now: written once into the shared folder, so that a later commit does not change them."""
        if commits is None:
            return None
        from tidemark.session import checkpoint_dir

        location = path(checkpoint_dir(self.spark), f"pinned-{uuid.uuid4().hex}")
        commits.write.parquet(location)
        return self.spark.read.schema(commits.schema).parquet(location)

    def pinned_state(self) -> DataFrame | None:
        return self.pinned(self.sync_state())

    def silver(self, name: str, state: DataFrame | None = None) -> DataFrame:
        """The committed rows of a table; by ``state``, if several tables must be of the same versions."""
        schema = schemas.schema_of(schemas.SILVER_TABLES[name])
        return read_committed(self.spark, self.silver_table(name), schema, self.sync_state() if state is None else state)

    def gold_commits(self) -> DataFrame | None:
        return latest_commits(self.spark, self.gold_log, schemas.GOLD_LOG)

    def gold(self, name: str, commits: DataFrame | None = None) -> DataFrame:
        """The committed rows of a mart; by ``commits``, if several marts must be of the same versions."""
        schema = schemas.schema_of(schemas.GOLD_TABLES[name])
        return read_committed(self.spark, self.gold_table(name), schema, self.gold_commits() if commits is None else commits)

    def register_views(self) -> None:
        """Temp views over the committed versions of every table."""
        for name in schemas.SILVER_TABLES:
            self.silver(name).createOrReplaceTempView(f"silver_{name}")
        state = self.sync_state()
        if state is not None:
            state.drop("version", "committed_at").createOrReplaceTempView("silver_sync_state")
        for name in schemas.GOLD_TABLES:
            self.gold(name).createOrReplaceTempView(f"gold_{name}")
        self.read_manifests().createOrReplaceTempView("bronze_manifests")
